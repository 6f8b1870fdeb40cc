"""DuckDB oracle SQL for every exactly-checkable query.

The fixture views are spliced in as CTEs from the same expression text Spark
uses (``riskfold.sources.fixtures``), so both engines read identical inputs.
Counts are cast to BIGINT and doubles rounded to 6 digits, as in the Spark
queries.
"""

from __future__ import annotations

from riskfold.operators.split import hash_bucket_sql
from riskfold.sources.fixtures import oracle_ctes
from riskfold.sources.requests import lineitem_requests_sql
from riskfold.sources.tables import TABLES

FLOATING = ("n_qty", "n_price", "n_disc", "n_sparse")
NUMERIC = ("n_qty", "n_price", "n_disc", "n_sparse", "n_line")
CATEGORICAL = ("c_flag", "c_status", "c_rare")
IDS = ("customer_id", "line_no", "date", "test")
ALL = IDS + ("target",) + NUMERIC + CATEGORICAL
ROLE = {**{c: "id" for c in IDS}, "target": "label", **{c: "numeric" for c in NUMERIC},
        **{c: "categorical" for c in CATEGORICAL}}
CLEAN_NUMERIC = ("n_qty", "n_price", "n_disc", "n_line")
CLEAN_CATEGORICAL = ("c_flag", "c_status")
SPARSE = ("n_sparse", "c_rare")


def pv(c: str, prefix: str = "") -> str:
    """Present value: NaN folded into NULL for floating columns."""
    q = prefix + c
    return f"CASE WHEN isnan({q}) THEN NULL ELSE {q} END" if c in FLOATING else q


def missing(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in FLOATING else f"({c} IS NULL)"


KEEP = (
    "(coalesce(" + ", ".join(f"CAST({pv(c)} AS DOUBLE)" for c in NUMERIC) + ") IS NOT NULL"
    " OR coalesce(" + ", ".join(f"CAST({c} AS VARCHAR)" for c in CATEGORICAL) + ") IS NOT NULL)"
)
S = oracle_ctes("statements")
SC = oracle_ctes("scored")
CLEAN = S + f", clean AS (SELECT * EXCLUDE ({', '.join(SPARSE)}) FROM statements WHERE {KEEP})\n"
MEANS = (
    ", m AS (SELECT " + ", ".join(f"avg(CAST({pv(c)} AS DOUBLE)) AS {c}" for c in CLEAN_NUMERIC)
    + " FROM clean)\n"
)
IMPUTED = (
    ", imp AS (SELECT clean.customer_id, clean.line_no, clean.date, clean.test, "
    + ", ".join(f"coalesce(CAST({pv(c, 'clean.')} AS DOUBLE), m.{c}) AS {c}"
                for c in CLEAN_NUMERIC)
    + " FROM clean, m)\n"
)


def R(x: str, alias: str) -> str:
    return f"round({x}, 6) AS {alias}"


def _profile(source: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{ROLE[c]}' AS role, count(*) AS n_rows, "
        f"CAST(count(*) - count({pv(c)}) AS BIGINT) AS n_missing FROM {source}"
        for c in cols
    )


def _rates(tp="tp", tn="tn", fp="fp", fn="fn") -> list[str]:
    def d(num, den):
        return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"

    prec, rec = d(tp, f"{tp} + {fp}"), d(tp, f"{tp} + {fn}")
    return [
        R(prec, "precision"), R(rec, "recall"),
        R(f"CASE WHEN ({prec}) + ({rec}) > 0 THEN 2 * ({prec}) * ({rec}) / (({prec}) + ({rec})) ELSE 0.0 END",
          "f1_score"),
        R(d(f"{tp} + {tn}", f"{tp} + {tn} + {fp} + {fn}"), "accuracy"),
        R(d(tn, f"{tn} + {fp}"), "specificity"),
        R(d(fp, f"{fp} + {tn}"), "false_alarm_rate"),
        R(f"1.0 - ({rec})", "miss_rate"),
    ]


CM = (
    ", cm AS (SELECT "
    "CAST(sum(CASE WHEN target = 1 AND prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
    "CAST(sum(CASE WHEN target = 0 AND prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
    "CAST(sum(CASE WHEN target = 0 AND prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
    "CAST(sum(CASE WHEN target = 1 AND prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
    "count(*) AS n_rows, CAST(sum(CASE WHEN prob IS NULL OR isnan(prob) THEN 1 ELSE 0 END) AS BIGINT) AS n_unscored "
    "FROM scored WHERE target IN (0, 1))\n"
)
ROC = (
    ", pts AS (SELECT CAST(prob AS DOUBLE) AS score, "
    "CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, "
    "CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg "
    "FROM scored WHERE target IN (0, 1) AND prob IS NOT NULL AND NOT isnan(prob) GROUP BY 1)\n"
    ", cum AS (SELECT score, pos, neg, "
    "CAST(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_pos, "
    "CAST(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_neg, "
    "CAST(sum(pos) OVER () AS BIGINT) AS n_pos, CAST(sum(neg) OVER () AS BIGINT) AS n_neg FROM pts)\n"
)
AUC = "sum(neg * (cum_pos - pos / 2.0)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg))"
LABELLED = "(SELECT target, count(*) AS n FROM statements WHERE target IS NOT NULL GROUP BY target)"
RQ = S.replace("WITH ", "WITH " + lineitem_requests_sql() + ", ", 1)



def _histogram(lo: str, hi: str) -> str:
    """60 bins a class between two aggregates of its scores; empty bins count 0."""
    return (
        f", e AS (SELECT target, {lo} AS lo, {hi} AS hi, count(*) AS n_class FROM scored "
        "WHERE target IN (0, 1) AND NOT isnan(prob) GROUP BY target)\n"
        ", b AS (SELECT s.target, CAST(least(greatest(floor((prob - lo) / (hi - lo) * 60), 0), 59) AS INTEGER) AS bin, "
        "count(*) AS n FROM scored s JOIN e ON s.target = e.target WHERE NOT isnan(prob) GROUP BY 1, 2)\n"
        ", g AS (SELECT target, lo, hi, n_class, CAST(unnest(range(60)) AS INTEGER) AS bin FROM e)\n"
        "SELECT g.target, g.bin, coalesce(b.n, 0) AS n, "
        + R("coalesce(b.n, 0) / (n_class * ((hi - lo) / 60))", "density") + ", "
        + R("lo + g.bin * ((hi - lo) / 60)", "bin_lo") + ", " + R("lo + (g.bin + 1) * ((hi - lo) / 60)", "bin_hi")
        + " FROM g LEFT JOIN b ON g.target = b.target AND g.bin = b.bin"
    )


SCHEMA_TYPES = {
    "customer_id": "bigint", "line_no": "int", "date": "string", "test": "boolean",
    "target": "int", "n_qty": "double", "n_price": "double", "n_disc": "double",
    "n_sparse": "double", "n_line": "int", "c_flag": "string", "c_status": "string", "c_rare": "string",
}
ORDER_ALL = ", ".join(f"{c} ASC NULLS LAST" for c in ALL)

ORACLE = {
    "scan_count": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "schema_report": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{c}', '{SCHEMA_TYPES[c]}', '{ROLE[c]}')" for i, c in enumerate(ALL)
    ) + ") AS t(position, column_name, dtype, role)",
    "preview_topk": S + f"SELECT * FROM statements ORDER BY {ORDER_ALL} LIMIT 20",
    "project_ids": S + "SELECT customer_id, date, target, test FROM statements",
    "missing_flags": S + "SELECT customer_id, line_no, " + ", ".join(
        f"CAST({missing(c)} AS INTEGER) AS {c}_missing" for c in NUMERIC + CATEGORICAL + ("target",)
    ) + " FROM statements",
    "null_nan_profile": S + _profile("statements", ALL),
    "null_nan_percent": S + "SELECT *, " + R("CAST(n_missing AS DOUBLE) / n_rows * 100", "pct_missing")
    + " FROM (" + _profile("statements", ALL) + ")",
    "drop_all_missing_rows": S + f"SELECT * FROM statements WHERE {KEEP}",
    "missing_rate": S + f", kept AS (SELECT * FROM statements WHERE {KEEP})\n"
    + "SELECT column_name, role, n_rows, n_missing, "
    + R("CAST(n_missing AS DOUBLE) / n_rows", "missing_rate")
    + ", CAST(n_missing AS DOUBLE) / n_rows > 0.95 AS sparse FROM ("
    + _profile("kept", NUMERIC + CATEGORICAL) + ")",
    "drop_sparse_columns": S + f"SELECT * EXCLUDE ({', '.join(SPARSE)}) FROM statements",
    "clean_table": CLEAN + "SELECT * FROM clean",
    "column_means": CLEAN + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {R(f'avg(CAST({pv(c)} AS DOUBLE))', 'mean')}, "
        f"count({pv(c)}) AS n_present FROM clean"
        for c in CLEAN_NUMERIC
    ),
    "impute_mean": CLEAN + MEANS + IMPUTED + "SELECT customer_id, line_no, date, test, "
    + ", ".join(R(c, c) for c in CLEAN_NUMERIC) + " FROM imp",
    "fill_categorical": CLEAN + "SELECT customer_id, line_no, date, test, "
    + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in CLEAN_CATEGORICAL) + " FROM clean",
    "string_index": CLEAN + "".join(
        f", ix_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i "
        f"FROM (SELECT coalesce({c}, 'missing') AS v, count(*) AS n FROM clean GROUP BY 1))\n"
        for c in CLEAN_CATEGORICAL
    ) + "SELECT clean.customer_id, clean.line_no, clean.date, clean.test, "
    + ", ".join(f"coalesce(clean.{c}, 'missing') AS {c}, ix_{c}.i AS {c}_idx" for c in CLEAN_CATEGORICAL)
    + " FROM clean " + " ".join(
        f"JOIN ix_{c} ON coalesce(clean.{c}, 'missing') = ix_{c}.v" for c in CLEAN_CATEGORICAL
    ),
    "standard_scale": CLEAN + MEANS + IMPUTED
    + ", st AS (SELECT " + ", ".join(
        f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in CLEAN_NUMERIC
    ) + " FROM imp)\nSELECT customer_id, line_no, date, test, " + ", ".join(
        R(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - a_{c}) / s_{c} END", f"{c}_z") for c in CLEAN_NUMERIC
    ) + " FROM imp, st",
    "label_prepare": S + "SELECT customer_id, line_no, CAST(target AS DOUBLE) AS target "
    "FROM statements WHERE target IS NOT NULL",
    "hash_split": S + "SELECT customer_id, line_no, CAST(target AS DOUBLE) AS target, "
    f"CASE WHEN {hash_bucket_sql('customer_id')} < 80 THEN 'train' ELSE 'test' END AS split "
    "FROM statements WHERE target IS NOT NULL",
    "class_distribution": S + "SELECT target, n, "
    + R("CAST(n AS DOUBLE) / sum(n) OVER () * 100", "percentage") + f" FROM {LABELLED} ORDER BY target",
    "class_weight_inverse": S + "SELECT target, n, "
    + R("CAST(sum(n) OVER () AS DOUBLE) / n", "weight") + f" FROM {LABELLED}",
    "class_weight_balanced": S + "SELECT target, n, "
    + R("CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n)", "weight") + f" FROM {LABELLED}",
    "class_weight_rows": S + ", w AS (SELECT target, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) "
    f"AS weight FROM {LABELLED})\n"
    "SELECT s.customer_id, s.line_no, CAST(s.target AS DOUBLE) AS target, round(coalesce(w.weight, 1.0), 6) "
    "AS class_weight FROM statements s LEFT JOIN w ON s.target = w.target WHERE s.target IS NOT NULL",
    "threshold_label": SC + "SELECT target, prob, CAST(prob >= 0.5 AS INTEGER) AS prediction FROM scored",
    "risk_band": SC + "SELECT CASE WHEN prob IS NULL THEN NULL WHEN prob < 0.3 THEN 'low' "
    "WHEN prob < 0.7 THEN 'medium' ELSE 'high' END AS risk_level, count(*) AS n, "
    "min(prob) AS min_prob, max(prob) AS max_prob FROM scored GROUP BY 1",
    "confusion_matrix": SC + CM + "SELECT tp, tn, fp, fn, n_rows, n_unscored FROM cm",
    "confusion_percent": SC + CM + "SELECT tp, tn, fp, fn, n_rows, n_unscored, " + ", ".join(
        R(f"CAST({c} AS DOUBLE) / n_rows * 100", f"{c}_pct") for c in ("tp", "tn", "fp", "fn")
    ) + " FROM cm",
    "classification_metrics": SC + CM + "SELECT tp, tn, fp, fn, n_unscored, " + ", ".join(_rates()) + " FROM cm",
    "roc_curve": SC + ROC + "SELECT score, pos, neg, cum_pos AS tp, cum_neg AS fp, "
    + R("CAST(cum_pos AS DOUBLE) / n_pos", "tpr") + ", " + R("CAST(cum_neg AS DOUBLE) / n_neg", "fpr")
    + ", n_pos, n_neg FROM cum",
    "auc_exact": SC + ROC + f"SELECT {R(AUC, 'auc')}, max(n_pos) AS n_pos, max(n_neg) AS n_neg FROM cum",
    "score_histogram": SC + _histogram("0.0::DOUBLE", "1.0::DOUBLE"),
    "score_histogram_edges": SC + _histogram("min(prob)", "max(prob)"),
    "metric_report": SC + ROC + f", agg AS (SELECT {AUC} AS auc, "
    "CAST(sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) AS BIGINT) AS tp, "
    "CAST(sum(CASE WHEN score >= 0.5 THEN 0 ELSE neg END) AS BIGINT) AS tn, "
    "CAST(sum(CASE WHEN score >= 0.5 THEN neg ELSE 0 END) AS BIGINT) AS fp, "
    "CAST(sum(CASE WHEN score >= 0.5 THEN 0 ELSE pos END) AS BIGINT) AS fn FROM cum)\n"
    f"SELECT {R('auc', 'auc')}, {R('auc * 0.855', 'auc_scaled')}, CAST(0.5 AS DOUBLE) AS threshold, "
    "tp, tn, fp, fn, (SELECT count(*) FROM scored WHERE target IN (0, 1) AND (prob IS NULL OR isnan(prob))) AS n_unscored, "
    + ", ".join(_rates()) + " FROM agg",
    "output_contract": SC + "SELECT count(*) AS n_rows, "
    "CAST(sum(CASE WHEN prediction IS NULL OR prediction NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) "
    "AS bad_prediction, CAST(sum(CASE WHEN probability IS NULL OR isnan(probability) OR probability < 0 "
    "OR probability > 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad_probability FROM "
    "(SELECT CAST(prob >= 0.5 AS INTEGER) AS prediction, prob AS probability FROM scored)",
    "request_to_columns": RQ + "SELECT customer_id, " + ", ".join(
        [f"TRY_CAST(features['{c}'] AS DOUBLE) AS {c}" for c in CLEAN_NUMERIC]
        + [f"features['{c}'] AS {c}" for c in CLEAN_CATEGORICAL]
    ) + " FROM requests",
    "request_valid": RQ + "SELECT customer_id, CAST(cardinality(features) AS INTEGER) AS n_features "
    "FROM requests WHERE features IS NOT NULL AND cardinality(features) > 0",
    "request_reject": RQ + "SELECT customer_id, CASE WHEN features IS NULL THEN 'features missing' "
    "ELSE 'features empty' END AS reason FROM requests "
    "WHERE features IS NULL OR cardinality(features) = 0",
}


# --- models, samples and layouts: what is exact of them ----------------------

LAB = CLEAN + ", lab AS (SELECT * FROM clean WHERE target IS NOT NULL)\n"
TRAIN = LAB + f", train AS (SELECT * FROM lab WHERE {hash_bucket_sql('customer_id')} < 80)\n"
HOLDOUT = f"(SELECT count(*) FROM lab WHERE {hash_bucket_sql('customer_id')} >= 80)"
VALID = "(SELECT count(*) FROM requests WHERE features IS NOT NULL AND cardinality(features) > 0)"


def _prepared() -> str:
    """Means and index orders of the training rows, then mean and deviation of what these give there."""
    sql = TRAIN + ", tm AS (SELECT " + ", ".join(f"avg(CAST({pv(c)} AS DOUBLE)) AS {c}" for c in CLEAN_NUMERIC) + " FROM train)\n"
    for c in CLEAN_CATEGORICAL:
        sql += (
            f", ix_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i "
            f"FROM (SELECT coalesce({c}, 'missing') AS v, count(*) AS n FROM train GROUP BY 1))\n"
        )
    num = ", ".join(f"coalesce(CAST({pv(c, 't.')} AS DOUBLE), tm.{c}) AS {c}" for c in CLEAN_NUMERIC)
    # a value that training has not seen gets the index after the last
    cat = ", ".join(f"coalesce(ix_{c}.i, (SELECT CAST(count(*) AS DOUBLE) FROM ix_{c})) AS {c}_idx" for c in CLEAN_CATEGORICAL)
    joins = " ".join(f"LEFT JOIN ix_{c} ON coalesce(t.{c}, 'missing') = ix_{c}.v" for c in CLEAN_CATEGORICAL)
    for name, source in (("pt", "train"), ("pc", "clean")):
        sql += f", {name} AS (SELECT t.customer_id, t.line_no, {num}, {cat} FROM {source} t CROSS JOIN tm {joins})\n"
    cols = [*CLEAN_NUMERIC, *[f"{c}_idx" for c in CLEAN_CATEGORICAL]]
    sql += ", st AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in cols) + " FROM pt)\n"
    return sql + "SELECT customer_id, line_no, " + ", ".join(
        R(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - a_{c}) / s_{c} END", f"{c}_z") for c in cols) + " FROM pc, st"


def _trained(preset: str, trees: int) -> str:
    n = len(CLEAN_NUMERIC) + len(CLEAN_CATEGORICAL)
    return LAB + (f"SELECT '{preset}' AS preset, {trees} AS n_trees, {n} AS n_features, {HOLDOUT} AS n_holdout, "
                  "CAST(0 AS BIGINT) AS n_unscored, true AS auc_above_floor")


_RUN = (
    f"'statements-script' AS model_name, 'script' AS preset, '{','.join(sorted(CLEAN_NUMERIC))}' AS numeric_cols, "
    f"'{','.join(sorted(CLEAN_CATEGORICAL))}' AS categorical_cols, {HOLDOUT} AS n_holdout, true AS auc_above_floor"
)
_INPUTS = ",".join(sorted([*[f"{c}_imp" for c in CLEAN_NUMERIC], *[f"{c}_idx" for c in CLEAN_CATEGORICAL]]))

ORACLE.update({
    "partition_stats": S + "SELECT count(*) AS n_rows, true AS one_row_each FROM statements",
    "random_split": S + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, "
    "true AS share_near_80 FROM statements WHERE target IS NOT NULL",
    "split_sizes": S + f", l AS (SELECT CASE WHEN {hash_bucket_sql('customer_id')} < 80 THEN 'train' ELSE 'test' END AS split "
    "FROM statements WHERE target IS NOT NULL)\nSELECT 'hash' AS method, split, count(*) AS n_rows FROM l GROUP BY split "
    "UNION ALL SELECT 'random', 'all', count(*) FROM l",
    "bernoulli_sample": SC + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_extra, true AS share_near_5 FROM scored",
    "prepare_features": _prepared(),
    "train_gbt_a": _trained("notebook", 60),
    "train_gbt_b": _trained("script", 100),
    "score_holdout": LAB + "SELECT customer_id, line_no, CAST(target AS DOUBLE) AS target, true AS in_contract FROM lab "
    f"WHERE {hash_bucket_sql('customer_id')} >= 80",
    "auc_evaluator": SC + ROC + f"SELECT {R(AUC, 'auc')}, {R(AUC, 'evaluator_auc')}, max(n_pos) AS n_pos, "
    "max(n_neg) AS n_neg FROM cum",
    "score_reload": LAB + f"SELECT {HOLDOUT} AS n_rows, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra",
    "score_bulk": RQ + "SELECT customer_id, true AS in_contract FROM requests "
    "WHERE features IS NOT NULL AND cardinality(features) > 0",
    "score_stream": RQ + f"SELECT {VALID} AS n_rows, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, "
    f"(SELECT count(*) FROM requests) - {VALID} AS n_rejected",
    "run_record": LAB + f"SELECT {_RUN}, '{','.join(sorted(SPARSE))}' AS dropped_cols, '{_INPUTS}' AS feature_input_cols, "
    "'target' AS label_col FROM range(2)",
    "model_info": LAB + f"SELECT {_RUN}, CAST(2 AS BIGINT) AS n_versions, {len(CLEAN_NUMERIC) + len(CLEAN_CATEGORICAL)} AS n_features",
})


# --- mergeable states, dictionaries as tables, request keys -------------------

def _state(c: str, group: str, source: str = "statements") -> str:
    number = f"CAST({pv(c)} AS DOUBLE)"
    of_kept = "CAST(n_kept - n_present AS DOUBLE) / nullif(n_kept, 0)" if ROLE[c] in ("numeric", "categorical") else "CAST(NULL AS DOUBLE)"
    stats = f"avg({number}) AS m, stddev_samp({number}) AS s" if ROLE[c] == "numeric" else "CAST(NULL AS DOUBLE) AS m, CAST(NULL AS DOUBLE) AS s"
    key = f"{group} AS state_key, " if group else ""
    return (
        f"SELECT {'state_key, ' if group else ''}'{c}' AS column_name, '{ROLE[c]}' AS role, n_rows, n_rows - n_present AS n_missing, "
        f"{R('CAST(n_rows - n_present AS DOUBLE) / n_rows * 100', 'pct_missing')}, n_kept, {R(of_kept, 'missing_rate')}, n_present, "
        f"{R('m', 'mean')}, {R('s', 'stddev')} FROM (SELECT {key}count(*) AS n_rows, count(*) FILTER (WHERE {KEEP}) AS n_kept, "
        f"count({pv(c) if ROLE[c] == 'numeric' else c}) AS n_present, {stats} FROM {source}{' GROUP BY 1' if group else ''})")


def _index(c: str, value: str | None = None) -> str:
    return (f"SELECT '{c}' AS column_name, v AS value, n, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx "
            f"FROM (SELECT coalesce(CAST({value or c} AS VARCHAR), 'missing') AS v, count(*) AS n FROM clean GROUP BY 1)")


_PRICE = f"CASE WHEN line_no % 3 = 0 THEN 'hot' ELSE CAST(CAST({pv('n_price')} AS DECIMAL(18,2)) AS VARCHAR) END"
_DICTIONARY = "\nUNION ALL\n".join([*[_index(c) for c in CLEAN_CATEGORICAL], _index("customer_id"), _index("v_price", _PRICE)])
_KINDS = ("CASE WHEN key IN (" + ", ".join(f"'{c}'" for c in CLEAN_NUMERIC) + ") THEN 'numeric' WHEN key IN ("
          + ", ".join(f"'{c}'" for c in CLEAN_CATEGORICAL) + ") THEN 'categorical' ELSE 'unknown' END")
_KEYS = RQ + (f", e AS (SELECT key, value, {_KINDS} AS kind FROM (SELECT unnest(map_keys(features)) AS key, unnest(map_values(features)) AS value "
              "FROM {features})),\nr AS (SELECT key, kind, count(*) AS n_requests, count(*) - count(value) AS n_null, "
              "count(*) FILTER (WHERE kind = 'numeric' AND value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) AS n_failed_cast "
              "FROM e GROUP BY key, kind)\n")

ORACLE.update({
    "profile_state_months": S + "\nUNION ALL\n".join(_state(c, "substr(date, 1, 7)") for c in ALL),
    "profile_state_merged": S + "\nUNION ALL\n".join(_state(c, "") for c in ALL),
    "value_dictionary": CLEAN + _DICTIONARY,
    "string_index_joined": CLEAN + f", x AS ({_DICTIONARY})\nSELECT t.customer_id, t.line_no, " + ", ".join(
        f"x_{c}.value AS {c}, CAST(x_{c}.idx AS DOUBLE) AS {c}_idx" for c in CLEAN_CATEGORICAL)
    + ", CAST(x_customer_id.idx AS DOUBLE) AS customer_id_idx FROM clean t " + " ".join(
        f"JOIN x x_{c} ON x_{c}.column_name = '{c}' AND x_{c}.value = coalesce(CAST(t.{c} AS VARCHAR), 'missing')"
        for c in (*CLEAN_CATEGORICAL, "customer_id")),
    "auc_sketch": SC + ROC + f", exact AS (SELECT {AUC} AS a FROM cum), k AS (SELECT least(greatest(floor(prob * 256), 0), 255) AS cell, "
    "CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) AS n, "
    "min(prob) AS lo, max(prob) AS hi FROM scored GROUP BY 1), w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY cell ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM k)\nSELECT "
    + R("sum(p * (below + n / 2)) / (sum(p) * sum(n))", "auc") + ", "
    + R("sum(CASE WHEN lo < hi THEN p * n / 2 ELSE 0 END) / (sum(p) * sum(n))", "error_bound")
    + ", CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg, CAST(0 AS BIGINT) AS n_unscored, "
    "abs(sum(p * (below + n / 2)) / (sum(p) * sum(n)) - (SELECT a FROM exact)) "
    "<= sum(CASE WHEN lo < hi THEN p * n / 2 ELSE 0 END) / (sum(p) * sum(n)) + 1e-12 AS within_bound FROM w",
    "request_key_report": _KEYS.format(features="requests") + "SELECT * FROM r",
    "request_key_top": _KEYS.format(features="""(SELECT CASE WHEN cardinality(features) > 0 THEN map_concat(features,
        MAP([concat('x_', CAST(customer_id AS BIGINT) % 97)], ['1'])) ELSE features END AS features FROM requests)""")
    + "SELECT CASE WHEN kind <> 'unknown' OR rank <= 10 THEN key END AS key, kind, CAST(sum(n_requests) AS BIGINT) AS n_requests, "
    "CAST(sum(n_null) AS BIGINT) AS n_null, CAST(sum(n_failed_cast) AS BIGINT) AS n_failed_cast FROM (SELECT *, row_number() OVER "
    "(PARTITION BY kind ORDER BY n_requests DESC, key) AS rank FROM r) GROUP BY 1, 2",
    "fit_layouts": "SELECT * FROM (VALUES (1, true), (4, true), (8, true)) AS v(input_partitions, same_trees)",
})


# --- wide statements: the same questions at ~190 columns ---------------------

from riskfold.roles import DEFAULT_CATEGORICAL_COLS  # noqa: E402
from riskfold.sources import fixtures as _fx  # noqa: E402

W_IDS = ("customer_ID", "date", "test")
W_NUM = tuple(f"n_{k:03d}" for k in range(_fx.WIDE_NUMERIC))
W_FLOAT = frozenset(f"n_{k:03d}" for k in range(_fx.WIDE_NUMERIC) if _fx._BASES[k % 5] != "l_linenumber")
W_CAT = tuple(DEFAULT_CATEGORICAL_COLS)
W_SPARSE = tuple(f"n_{k:03d}" for k in range(_fx.WIDE_NUMERIC) if k % 45 == 7) + ("D_68",)
W_ALL = W_IDS + ("target",) + W_NUM + W_CAT
W_ROLE = {**{c: "id" for c in W_IDS}, "target": "label", **{c: "numeric" for c in W_NUM},
          **{c: "categorical" for c in W_CAT}}
W_CLEAN_NUM = tuple(c for c in W_NUM if c not in W_SPARSE)
W_CLEAN_CAT = tuple(c for c in W_CAT if c not in W_SPARSE)


def wpv(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" if c in W_FLOAT else c


W_KEEP = (
    "(coalesce(" + ", ".join(f"CAST({wpv(c)} AS DOUBLE)" for c in W_NUM) + ") IS NOT NULL"
    " OR coalesce(" + ", ".join(f"CAST({c} AS VARCHAR)" for c in W_CAT) + ") IS NOT NULL)"
)
WS = oracle_ctes("wide")
W_CLEAN = WS + f", clean AS (SELECT * EXCLUDE ({', '.join(W_SPARSE)}) FROM wide WHERE {W_KEEP})\n"


def _wprofile(source: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{W_ROLE[c]}' AS role, count(*) AS n_rows, "
        f"CAST(count(*) - count({wpv(c)}) AS BIGINT) AS n_missing FROM {source}"
        for c in cols
    )


ORACLE.update({
    "wide_null_nan_percent": WS + "SELECT *, " + R("CAST(n_missing AS DOUBLE) / n_rows * 100", "pct_missing")
    + " FROM (" + _wprofile("wide", W_ALL) + ")",
    "wide_missing_rate": WS + f", kept AS (SELECT * FROM wide WHERE {W_KEEP})\n"
    + "SELECT column_name, role, n_rows, n_missing, "
    + R("CAST(n_missing AS DOUBLE) / n_rows", "missing_rate")
    + ", CAST(n_missing AS DOUBLE) / n_rows > 0.95 AS sparse FROM ("
    + _wprofile("kept", W_NUM + W_CAT) + ")",
    "wide_clean_table": W_CLEAN + "SELECT * FROM clean",
    "wide_column_means": W_CLEAN + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {R(f'avg(CAST({wpv(c)} AS DOUBLE))', 'mean')}, "
        f"count({wpv(c)}) AS n_present FROM clean"
        for c in W_CLEAN_NUM
    ),
    "wide_string_index": W_CLEAN + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, v AS value, "
        f"CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx, n "
        f"FROM (SELECT coalesce(CAST({c} AS VARCHAR), 'missing') AS v, count(*) AS n FROM clean GROUP BY 1)"
        for c in W_CLEAN_CAT
    ),
})
