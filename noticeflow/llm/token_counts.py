"""Token counts of the parts of a text: offset-mapped attribution.

A whole text is encoded once. The byte spans of its tokens become character spans (a token
that holds a part of a character spans that character), which are joined as intervals to the
sections. A token inside one section is that section's. One that crosses a boundary goes by
``rule``:

- ``most``: to the section that holds most of its characters, the earlier one of equals,
- ``first`` or ``last``: to the section of its first or last character that is in any,
- ``share``: to every section it touches, by its share of the token's characters.

Sections are given as an array of (start, end) character spans that do not overlap, in order;
without it each line with its line feed is a section. Tokens that touch no section are counted in a row
with section -1, if there are any.

Edge cases. A null or empty text has one empty section by lines. Null or empty arrays of
sections leave only the row for section -1. Sections may be empty, reach beyond the text, or
leave gaps. Repeated rows give their rows each; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.bpe import encoder, shared
from noticeflow.llm.common import by_pieces, texts_of

RULES = ("most", "first", "last", "share")


def line_spans(text: str) -> list[tuple[int, int]]:
    spans, at = [], 0
    for line in text.split("\n"):
        spans.append((at, at + len(line) + 1))
        at += len(line) + 1
    spans[-1] = (spans[-1][0], len(text))
    return spans[:-1] if len(spans) > 1 and spans[-1][0] == len(text) else spans


def token_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last, of each token."""
    ends = np.cumsum(sizes[ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) == len(text):
        return ends - sizes[ids], ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[ends - sizes[ids]], char[ends - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section, and tokens of none."""
    out = np.zeros(len(spans))
    real = np.array([k for k, (s, e) in enumerate(spans) if e > s], np.int64)  # an empty one holds nothing
    starts = np.array([spans[k][0] for k in real], np.int64)
    ends = np.array([spans[k][1] for k in real], np.int64)
    low, high = np.searchsorted(ends, first, "right"), np.searchsorted(starts, end, "left")
    one = np.flatnonzero(high - low == 1)
    own = low[one]
    np.add.at(out, real[own], (np.minimum(end[one], ends[own]) - np.maximum(first[one], starts[own])) / (end - first)[one]
              if rule == "share" else 1)
    outside = float((high <= low).sum())
    for t in np.flatnonzero(high - low > 1):
        own = np.arange(low[t], high[t])
        shares = np.maximum(np.minimum(end[t], ends[own]) - np.maximum(first[t], starts[own]), 0) / (end[t] - first[t])
        if rule == "share":
            out[real[own]] += shares
        else:
            out[real[own[{"most": shares.argmax(), "first": 0, "last": len(own) - 1}[rule]]]] += 1
    return out, outside


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 sections_col: str | None = None, *, rule: str = "most") -> DataFrame:
    """A row for each section of each row of ``docs``: doc_id, section (from 0), start, end (in
    characters), n_tokens (double for ``share``)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocabulary = shared(docs.sparkSession, path)
    number, kind_out = (pa.float64(), "double") if rule == "share" else (pa.int64(), "long")
    names = ["section", "start", "end", "n_tokens"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary.value)
        sizes = np.array([len(b) for b in vocabulary.value.token_bytes])
        texts = texts_of(batch, "text")
        lists = batch.column("sections").to_pylist() if sections_col else [None] * len(texts)
        lines: list[tuple] = []
        rows = []
        for at, (text, ids, given) in enumerate(zip(texts, enc.encode(texts), lists, strict=True)):
            spans = [(s["start"], s["end"]) for s in given or ()] if sections_col else line_spans(text)
            tokens, outside = attribute(*token_spans(text, np.frombuffer(ids, "<u4"), sizes), spans, rule)
            lines += [(k, s, e, n) for k, ((s, e), n) in enumerate(zip(spans, tokens.tolist(), strict=True))]
            rows += [at] * len(spans)
            if outside:
                lines.append((-1, None, None, outside))
                rows.append(at)
        kinds = [pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array([x[k] for x in lines], kind) for k, kind in enumerate(kinds)]
        arrays.append(pa.array([x[3] for x in lines], pa.float64()).cast(number))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *arrays], ["doc_id", *names])

    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    if sections_col:
        columns.append(F.col(sections_col).cast("array<struct<start:long,end:long>>").alias("sections"))
    rows = docs.select(*columns)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_pieces(work, "text"),
                           f"doc_id {kind}, section int, start long, end long, n_tokens {kind_out}")
