"""Token counts by offset-mapped attribution.

A whole document, all its fields joined, is encoded once.  The byte lengths of
its tokens add up to their spans; sections (fields, or the lines of fields)
are spans of the same bytes.  Joining the two interval lists, both sorted, by
binary search attributes each token.  A token that lies across a boundary is
given away by a stated rule:

* ``first``: to the section that holds its first byte (counts are whole);
* ``most``: to the section that holds most of its bytes, the earlier on a tie;
* ``share``: to each section by its share of the token's bytes.

Under every rule a document's counts add up to its tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern of this public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "most", "share")


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks by token.  A vocabulary file has a fixed, small size; executors get it with the task."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section.  Token i covers bytes starts[i]..ends[i]; section j bounds[j]..bounds[j + 1]."""
    n = len(bounds) - 1
    first = np.searchsorted(bounds, starts, side="right") - 1
    if rule == "first":
        return np.bincount(first, minlength=n).astype(float)[:n]
    last = np.searchsorted(bounds, ends, side="left") - 1
    out = np.bincount(first[first == last], minlength=n).astype(float)
    for i in np.nonzero(first != last)[0]:
        at = np.arange(first[i], last[i] + 1)
        held = np.minimum(bounds[at + 1], ends[i]) - np.maximum(bounds[at], starts[i])
        if rule == "share":
            out[at] += held / (ends[i] - starts[i])
        else:
            out[at[held.argmax()]] += 1
    return out


def count_tokens(docs: DataFrame, *, fields: Sequence[str] = ("text",), lines: bool = True, rule: str = "first",
                 separator: str = "\n", vocabulary: str = VOCABULARY, pattern: str = PATTERN,
                 id_col: str = "doc_id") -> DataFrame:
    """The id, field, section (its number within the field, from 0), start and end (bytes in the field), n_tokens
    (double; whole but under ``share``) and doc_tokens, one row for each section of each document.

    With ``lines`` a section is a line with its line break, else a whole field.
    Fields are joined by ``separator`` for encoding; a separator's bytes belong
    to the field before it (to its last section) but are not in start..end.

    A null field counts as empty; an empty field is one section without
    tokens of its own.  Null ids stay, repeated rows get their sections each,
    and an empty table gives no rows.  Other columns are ignored, whatever
    their names.  Texts have no length limit: one document is encoded at a time.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    if not fields:
        raise ValueError("at least one field is needed")
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    names = list(fields)
    gap = separator.encode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        lengths = np.zeros(max(ranks.value.values()) + 1, dtype=np.int64)
        for token, r in ranks.value.items():
            lengths[r] = len(token)
        for b in batches:
            parts: dict[str, list] = {c: [] for c in ("row", "field", "section", "start", "end", "n_tokens", "doc_tokens")}
            for row, values in enumerate(zip(*[b[f"f{i}"] for i in range(len(names))])):
                raws = [v.encode("utf-8", "replace") for v in values]
                ids = np.asarray(encoder.encode_to_numpy(gap.join(raws).decode("utf-8"), disallowed_special=()), dtype=np.int64)
                ends = np.cumsum(lengths[ids])
                starts = ends - lengths[ids]
                field_no, section_no, local, bounds, base = [], [], [], [], 0
                for i, raw in enumerate(raws):
                    cuts = np.zeros(1, dtype=np.int64)
                    if lines:
                        breaks = np.nonzero(np.frombuffer(raw, dtype=np.uint8) == 10)[0] + 1
                        cuts = np.concatenate([cuts, breaks[breaks < len(raw)]])
                    field_no.append(np.full(len(cuts), i))
                    section_no.append(np.arange(len(cuts)))
                    local.append(np.stack([cuts, np.append(cuts[1:], len(raw))]))
                    bounds.append(base + cuts)
                    base += len(raw) + (len(gap) if i + 1 < len(raws) else 0)
                edges = np.append(np.concatenate(bounds), base)
                spans = np.concatenate(local, axis=1)
                got = attribute(starts, ends, edges, rule)
                for c, v in (("row", np.full(len(got), row)), ("field", np.concatenate(field_no)), ("section", np.concatenate(section_no)),
                             ("start", spans[0]), ("end", spans[1]), ("n_tokens", got), ("doc_tokens", np.full(len(got), len(ids)))):
                    parts[c].append(v)
            flat = {c: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for c, v in parts.items()}
            yield pd.DataFrame({
                "_id": b["_id"].take(flat["row"]).reset_index(drop=True), "field": np.array(names, dtype=object)[flat["field"]],
                "section": flat["section"], "start": flat["start"], "end": flat["end"],
                "n_tokens": flat["n_tokens"].astype(float), "doc_tokens": flat["doc_tokens"]})

    kind = docs.schema[id_col].dataType.simpleString()
    whole = docs.select(F.col(id_col).cast("string").alias("_id"),
                        *[F.coalesce(F.col(c), F.lit("")).alias(f"f{i}") for i, c in enumerate(names)])
    out = whole.mapInPandas(run, "_id string, field string, section long, start long, `end` long, n_tokens double, doc_tokens long")
    return out.select(F.col("_id").cast(kind).alias(id_col), "field", "section", "start", "end", "n_tokens", "doc_tokens")


def op4_offset_mapped_tokens(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
