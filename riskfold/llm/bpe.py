"""When merging by rank alone gives a tokenizer's own ids.

A tokenizers file lists the pairs that merge, in order; tiktoken merges any
two neighbours whose joined bytes have a rank, lowest first.  Both do the same
if ids rise with the order of the merges, and if the bytes of each token,
merged by the tokens before it alone, end as just the pair that its rule
names: two neighbours that make up a token have come about inside its span, by
merges before it and by none across its ends, so they are that pair.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def same_as_ranks(ranks: Mapping[bytes, int], rules: Sequence[tuple[bytes, bytes]]) -> bool:
    """Whether merging by ``ranks`` is the same as by ``rules`` (pairs in order)."""
    last = -1
    for left, right in rules:
        rank = ranks.get(left + right)
        if rank is None or rank <= last or _pair_of(left + right, rank, ranks) != (left, right):
            return False
        last = rank
    return True


def _pair_of(token: bytes, below: int, ranks: Mapping[bytes, int]) -> tuple[bytes, ...]:
    """``token`` merged by the ranks under ``below``."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], below)
            if rank < best:
                best, at = rank, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts)
