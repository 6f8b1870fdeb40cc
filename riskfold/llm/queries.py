"""The registered query of each operator, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.llm import (
    alignment, chat, decontamination, licenses, lm_scoring, mixing, ngram_join, prefix_trie, quality_rules, sharding, token_output,
    toxicity, warc,
)
from riskfold.llm.tables import ROW, fresh_path, written
from riskfold.sources.tables import read_table

N_SHARDS = 40


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file; every machine has the package that holds it."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    taken = mixed.groupBy(ROW).agg(F.sum("words").alias("taken"))
    return docs.join(taken, ROW, "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_chat(turns.unionByName(more)))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_output.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_output.with_checksums(token_output.read_tokens(spark, path))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), path)
    records = warc.read_warc(spark, path).select(
        "record_id", "record_type", "page_id", "refers_to_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
    )
    records = written(records, "warc-read")
    stored = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest",
    )
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        stored, "refers_to_id", "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(*columns).unionByName(revisits.select(*columns))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    sharded = sharding.with_shards(docs, ["doc_id"], [1.0] * N_SHARDS)
    slotted = sharding.with_slots(sharded, "shard", ["doc_id"], ["size", "text_crc32"])
    return sharding.with_shards(slotted, ["doc_id"], [1.0] * (N_SHARDS + 1), into="grown_shard")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality(docs, into="q").select("doc_id", "q.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), into="leak")
    return leaks.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        decontamination.items_digest(F.col("leak.items")).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm_scoring.lm_scores(docs, lm_scoring.trained(F.col("doc_id"))).withColumnRenamed("id", "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = toxicity.held_out(F.col("doc_id"))
    field = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, field, into="t").select(
        "doc_id", held.alias("held_out"), "t.score", (F.col("t.score") >= 0.5).cast("int").alias("predicted"),
        F.size("t.spans").cast("long").alias("n_spans"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, into="found")
    scanned = F.col("found")
    return found.select(
        "doc_id", "found.n_words", "found.n_base", "found.first_word", "found.last_word",
        F.array_join("found.base_labels", ",").alias("base_labels"),
        F.array_join(licenses.labels_of(scanned), ",").alias("labels"), licenses.score_of(scanned).alias("score"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = alignment.Tokenizers(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return alignment.aligned_scores(read_table(spark, sf_dir, "documents"), both).withColumnRenamed("id", "doc_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def _license_sql() -> str:
    """DuckDB SQL of ``op11_license_scan``: places of the phrases, and each block's words against each template's."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    words = lambda t: [w.decode() for w in licenses.normal_words(t.encode())]
    templates = ", ".join(f"({quoted(label)}, [{', '.join(map(quoted, words(t)))}])" for label, t in licenses.TEMPLATES)
    phrases = ", ".join(f"({quoted(label)}, [{', '.join(map(quoted, words(t)))}])" for t, label in licenses.PHRASES)
    half = max(len(words(t)) for _, t in licenses.TEMPLATES)
    return rf"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        t AS (SELECT label, list_distinct(w) AS w, len(list_distinct(w)) AS size FROM (VALUES {templates}) AS v(label, w)),
        p AS (SELECT * FROM (VALUES {phrases}) AS v(label, w)),
        x AS (SELECT r, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
        base AS (
            SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels, list(DISTINCT label) AS ls
            FROM (SELECT d.r, p.label, x.i FROM x JOIN p ON x.word = p.w[1] JOIN d ON d.r = x.r
                  WHERE d.w[x.i + 1:x.i + len(p.w)] = p.w) GROUP BY r),
        tw AS (SELECT label, size, unnest(w) AS word FROM t),
        b AS (
            SELECT r, n, word, unnest([i // {half}, i // {half} - 1]) AS block FROM x WHERE word IN (SELECT word FROM tw)),
        m AS (
            SELECT r, block, label, size, count(DISTINCT b.word) AS shared
            FROM b JOIN tw ON b.word = tw.word
            WHERE block BETWEEN 0 AND greatest(0, (n + {half} - 1) // {half} - 2)
            GROUP BY r, block, label, size HAVING 100 * count(DISTINCT b.word) >= {licenses.THRESHOLD} * size),
        f AS (SELECT r, max(CAST(shared AS DOUBLE) / size) AS share, list(DISTINCT label) AS ls FROM m GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(f.ls, [])))), ',') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0) END AS score
        FROM d LEFT JOIN base USING (r) LEFT JOIN f USING (r)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_chat": op2_chat,
    "op3_token_output": op3_token_output,
    "op4_warc": op4_warc,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_join": op10_ngram_join,
    "op11_license_scan": op11_license_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op1_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
            FROM d GROUP BY source),
        r AS (
            SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, 2 * source_size / weight AS ratio FROM s),
        c AS (
            SELECT *, coalesce(sum(cap) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS weights,
                   sum(cap) OVER () / 2 * 1.5::DOUBLE AS budget, sum(weight) OVER () AS all_weights,
                   row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place
            FROM r WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (
            SELECT arg_min((budget - caps) / (all_weights - weights), place) AS level
            FROM c WHERE (budget - caps) / (all_weights - weights) <= ratio),
        t AS (
            SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target
            FROM c, l),
        p AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
                   coalesce(sum(d.size) OVER (
                       PARTITION BY d.source ORDER BY md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(greatest(0, least(start + size, take) - start)
                    + greatest(0, least(source_size + start + size, take) - source_size - start) AS BIGINT) AS taken
        FROM p""",
    "op2_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        k AS (
            SELECT unnest(['\', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '<<ROLE>>', '<</ROLE>>']) AS c),
        n AS (
            SELECT *, len(text) + (SELECT CAST(sum((len(text) - len(replace(text, c, ''))) // len(c)) AS BIGINT) FROM k)
                   + CASE role WHEN 'system' THEN 24 WHEN 'user' THEN 22 WHEN 'assistant' THEN 7
                     ELSE 24 + len(role) + (SELECT CAST(sum((len(role) - len(replace(role, c, ''))) // len(c)) AS BIGINT) FROM k)
                     END AS chars,
                   lag(role) OVER w AS last, lead(role) OVER w AS next, row_number() OVER w AS no
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        v AS (
            SELECT *, CASE
                WHEN last IS NULL AND no = 1 THEN role IN ('system', 'user')
                WHEN last NOT IN ('system', 'user', 'assistant') THEN role IN ('system', 'user')
                ELSE (last, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END AS ok
            FROM n)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY no)) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars,
               bool_and(ok) AND arg_max(role, no) = 'assistant' AS valid,
               CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS n_wrong_turns
        FROM v GROUP BY conv_id""",
    "op4_warc": r"""
        WITH p AS (
            SELECT page_id, row_number() OVER () AS r, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT *, first_value(r) OVER w AS fr, first_value(page_id) OVER w AS fp
            FROM p WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r))
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND r <> fr THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND r <> fr THEN fp END AS refers_to
        FROM f""",
    "op7_decontamination": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        p AS (
            SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS pattern, least(len(w), 10) AS n
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        n AS (SELECT DISTINCT n FROM p),
        g AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
        m AS (SELECT r, i, g.n, item FROM g JOIN p ON g.gram = p.pattern AND g.n = p.n),
        h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM m) GROUP BY r),
        s AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)""",
    "op10_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
            FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        l AS (
            SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * i >= 80 * (na.n + nb.n - i)),
        r(doc_id, root) AS (
            SELECT doc_id, doc_id FROM d
            UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY 1, 2""",
    "op11_license_scan": _license_sql(),
    "op13_prefix_trie": r"""
        WITH o AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
            FROM conversations WHERE conv_id IS NOT NULL),
        k AS (
            SELECT c, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
                lambda h, x: list_reduce(
                    [xor(h, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))), 4294967295::BIGINT) % 9 AS h
            FROM (SELECT DISTINCT c FROM o)),
        u AS (
            SELECT k.c, 0 AS part, i, role, text FROM k JOIN o ON o.c = k.c - k.c % 5 AND o.i < k.h
            UNION ALL SELECT k.c, 1, i, role, text FROM k JOIN o ON o.c = k.c AND o.i >= k.h),
        n AS (
            SELECT c, row_number() OVER w AS d, strlen(text) AS size,
                   string_agg(len(role) || ':' || len(text) || ':' || role || text, '') OVER w AS prefix
            FROM u WINDOW w AS (PARTITION BY c ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        a AS (SELECT c, d, size, prefix FROM n UNION ALL SELECT c, 0, 0, '' FROM k),
        e AS (SELECT c, max(d) AS turns FROM a GROUP BY c),
        v AS (
            SELECT d, prefix, min(a.c) AS conv_id, count(*) AS n_convs, min(size) AS size,
                   coalesce(string_agg(CASE WHEN turns = d THEN CAST(a.c AS VARCHAR) END, ',' ORDER BY a.c), '') AS ends
            FROM a JOIN e ON e.c = a.c GROUP BY d, prefix),
        g AS (SELECT v.*, p.conv_id AS up FROM v JOIN a x ON x.c = v.conv_id AND x.d = v.d - 1 JOIN v p ON p.d = x.d AND p.prefix = x.prefix),
        q AS (SELECT up AS conv_id, d - 1 AS d, count(*) AS n_children FROM g GROUP BY ALL),
        l AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN q USING (conv_id, d)),
        s AS (
            SELECT x.d, x.prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * l.size) AS saved
            FROM l JOIN a x ON x.c = l.conv_id AND x.d <= l.d GROUP BY x.d, x.prefix)
        SELECT l.conv_id, CAST(l.d AS BIGINT) AS depth, g.up AS parent_conv_id, l.n_convs, l.n_children,
               CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(l.ends) AS ends_sha256
        FROM l JOIN s ON s.d = l.d AND s.prefix = l.prefix LEFT JOIN g ON g.d = l.d AND g.prefix = l.prefix""",
}
