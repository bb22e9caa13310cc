"""Token counts that follow edits without encoding whole texts again.

A document is cut after white space into leaves of a few hundred characters. Two segment
trees hold the characters and the tokens of the leaves. An edit finds its leaves by descending
the tree of characters, and takes one character of context on either side, since a word ends
where its neighbour is white space; only those leaves are encoded again and the sums on the
way to the root updated. If an edit removes the white space that ended its last leaf, the next
leaf joins in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import slices, texts_of
from sigweave.llm.tokens import WordEncoder, encoder, split_words, vocabulary_path

LEAF_CHARS = 256
_SPACE = " \t\n\r\x0b\x0c"
_LEAF = re.compile(rf"[\s\S]{{{LEAF_CHARS}}}[^{_SPACE}]*[{_SPACE}]|[\s\S]+")
EDITS = "array<struct<start:long,end:long,text:string>>"


def leaves_of(text: str) -> list[str]:
    return _LEAF.findall(text)


class SumTree:
    """Sums over leaves: point update and search by prefix in logarithmic time."""

    def __init__(self, values: list[int]):
        self.size = 1
        while self.size < max(1, len(values)):
            self.size *= 2
        self.sums = [0] * self.size + list(values) + [0] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def set(self, leaf: int, value: int) -> None:
        i = self.size + leaf
        change = value - self.sums[i]
        while i:
            self.sums[i] += change
            i //= 2

    def find(self, place: int) -> tuple[int, int]:
        """Leaf that holds ``place`` (below the total) and the sum before it."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if place - before >= self.sums[i]:
                before += self.sums[i]
                i += 1
        return i - self.size, before


class CountedText:
    """A text with the token counts of its leaves."""

    def __init__(self, leaves: list[str], tokens: list[int], encode: WordEncoder):
        self.leaves = list(leaves) or [""]
        self._encode = encode
        self.chars = SumTree([len(x) for x in self.leaves])
        self.tokens = SumTree(list(tokens) or [0])
        self.encoded_chars = 0

    @classmethod
    def of(cls, text: str, encode: WordEncoder) -> CountedText:
        leaves = leaves_of(text)
        return cls(leaves, [encode.count(x) for x in leaves], encode)

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace characters start to end (exclusive, held within the text) by ``text``."""
        total = self.chars.total
        start = max(0, min(start, total))
        end = max(start, min(end, total))
        if start == end and not text:
            return
        first, before = self.chars.find(max(0, min(start - 1, total - 1)))
        last, at = self.chars.find(max(0, min(end, total - 1)))
        region = "".join(self.leaves[first : last + 1])
        region = region[: start - before] + text + region[end - before :]
        del at
        while last + 1 < len(self.leaves) and region[-1:] not in _SPACE and region:
            last += 1
            region += self.leaves[last]
        self._put(first, last, region)

    def _put(self, first: int, last: int, region: str) -> None:
        parts = leaves_of(region)
        room = last - first + 1
        if len(parts) > room:
            # More leaves than before: new trees over the old counts; only the region is encoded.
            counts = [self._encode.count(x) for x in parts]
            tokens = [self.tokens.sums[self.tokens.size + i] for i in range(len(self.leaves))]
            self.leaves[first : last + 1] = parts
            tokens[first : last + 1] = counts
            self.chars, self.tokens = SumTree([len(x) for x in self.leaves]), SumTree(tokens)
        else:
            for i in range(room):
                part = parts[i] if i < len(parts) else ""
                self.leaves[first + i] = part
                self.chars.set(first + i, len(part))
                self.tokens.set(first + i, self._encode.count(part))
        self.encoded_chars += len(region)


def recount(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token counts of every document before and after its edits.

    ``docs`` has doc_id, text and edits, an array of (start, end, text) applied one after
    another to what the earlier ones left. Columns: doc_id, tokens_before, tokens_after,
    chars_after, encoded_chars (what the edits had to encode again), leaf_chars and
    leaf_tokens (the state after the edits). A null text is empty; a null array or edit changes
    nothing; a null bound is 0, a null replacement empty; places outside of the text are moved
    to its ends. Rows that repeat are counted as often as they come; other columns are not read.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches, "text"):
            cut = [leaves_of(t or "") for t in batch.column("text").to_pylist()]
            codes, distinct, starts = split_words(
                pa.array([x for c in cut for x in c], pa.large_string())
            )
            words = np.concatenate([[0], np.cumsum(encode.counts(distinct)[codes])])
            counts = np.diff(words[starts]).tolist()
            rows, at = [], 0
            for leaves, edits in zip(cut, batch.column("edits").to_pylist(), strict=True):
                doc = CountedText(leaves, counts[at : at + len(leaves)], encode)
                at += len(leaves)
                before = doc.tokens.total
                for e in edits or ():
                    if e is not None:
                        doc.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                n = len(doc.leaves)
                rows.append(
                    (
                        before, doc.tokens.total, doc.chars.total, doc.encoded_chars,
                        doc.chars.sums[doc.chars.size :][:n], doc.tokens.sums[doc.tokens.size :][:n],
                    )
                )
            longs = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), longs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", *"tokens_before tokens_after chars_after encoded_chars".split(),
                 "leaf_chars", "leaf_tokens"],
            )

    source = texts_of(docs, F.col("edits").cast(EDITS).alias("edits"))
    return source.mapInArrow(
        run,
        "doc_id long, tokens_before long, tokens_after long, chars_after long,"
        " encoded_chars long, leaf_chars array<long>, leaf_tokens array<long>",
    )


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the array of their edits from a table (doc_id, seq, start, end, text)."""
    per_doc = edits.groupBy("doc_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("seq", "start", "end", "text"))),
            lambda e: F.struct(e["start"], e["end"], e["text"]),
        )
        .cast(EDITS)
        .alias("edits")
    )
    return docs.select("doc_id", "text").join(per_doc, "doc_id", "left")
