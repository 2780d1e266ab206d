"""Exact token counts of texts of any length, with bounded memory.

A *proven stable boundary* is a position right after an ASCII white-space character.
The tokenizer's pre-tokenizer drops white space and never joins what stands on both
sides of it, its normaliser turns each run of white space into one blank and composes
no character across it, and no special token contains any.  So the tokens of a text are
those of the part before such a boundary followed by those of the part after it.

* Huge texts (over ``chunk_chars`` code points) are encoded by the library in
  overlapping chunks with offsets.  Two neighbours are spliced at the last stable
  boundary inside their overlap at which both have a token start.  Where the overlap has
  none, it is widened until it has one; a run without white space thus ends up in one
  chunk, as the library itself would see it.
* All other texts are cut at every stable boundary.  Each distinct piece is encoded by
  the library once per worker and its count kept in a bounded two-generation memo.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import ship_package

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
MEMO_PIECES = 500_000
#: Texts of one Arrow batch are taken in slices of about so many bytes.
SLICE_BYTES = 16 << 20

_SPACE = " \t\n\x0b\x0c\r"


def spliced_count(encode, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text`` by overlapping chunks.

    ``encode(part)`` gives the start offset of each token of ``part``, in order.
    """
    total, n = 0, len(text)
    begin, end = 0, min(len(text), chunk)
    starts = [begin + s for s in encode(text[begin:end])]
    taken_from = 0  # tokens that start before it are counted already
    while end < n:
        wide, joint = overlap, None
        while joint is None:
            left = end - wide
            if left <= taken_from:
                # No boundary in the whole chunk: grow the chunk itself.
                end = min(n, end + max(chunk, end - taken_from))
                starts = [taken_from + s for s in encode(text[taken_from:end])]
                if end == n:
                    return total + len(starts)
                wide = overlap
                continue
            right = min(n, max(left + chunk, end + overlap))
            other = [left + s for s in encode(text[left:right])]
            both = set(starts).intersection(other)
            joint = max((p for p in both if left < p < end and text[p - 1] in _SPACE), default=None)
            if joint is None:
                wide *= 2
        total += sum(1 for s in starts if taken_from <= s < joint)
        taken_from, end = joint, right
        starts = [s for s in other if s >= joint]
    return total + sum(1 for s in starts if s >= taken_from)


#: What a tokenizer is tried on before its pieces are counted apart.
_TRIALS = ("The", "quick", "BROWN", "fox", "naïve", "x", "don't", "日本語", "zzqx", "12.5", "a_b", "é", "state-of", "🙂", "word.", "Mixed")


def parts_at_blanks(tokenizer) -> bool:
    """Whether ASCII white space parts words and gives no token of its own, on trials."""

    def count(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    alone = {w: count(w) for w in _TRIALS}
    pairs = [(a, b) for i, a in enumerate(_TRIALS) for b in (_TRIALS[i - 1], _TRIALS[i - 5])]
    return all(
        count(f"{a}{gap}{b}") == alone[a] + alone[b] and count(f"{gap}{a}{gap}{gap}{b}{gap}") == alone[a] + alone[b]
        for a, b in pairs
        for gap in " \t\n\x0b\x0c\r"
    )


def folds_case_and_marks(tokenizer) -> bool:
    """Whether ASCII case does not matter and a mark behind a word stands alone, on trials."""

    def count(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    words = [w for w in (*_TRIALS, "HELLO", "iPhone", "token", "SomeLongerWord", "Q") if w.isascii() and w.isalpha()]
    return all(count(w) == count(w.lower()) and count(w + m) == count(w.lower()) + count(m) for w in words for m in ".,")


class PieceMemo:
    """Token counts of pieces without white space; at most twice ``size`` are kept."""

    def __init__(self, tokenizer, size: int = MEMO_PIECES):
        self.tokenizer, self.size = tokenizer, size
        self.folds = folds_case_and_marks(tokenizer)
        self.new: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def _encode(self, pieces: list[bytes]) -> None:
        for i in range(0, len(pieces), 5000):
            part = pieces[i : i + 5000]
            got = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.new.update(zip(part, map(len, got), strict=True))

    def learn(self, pieces: set[bytes]) -> None:
        """After this call ``self.new`` knows all ``pieces``."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        unknown = [p for p in pieces if p not in self.new]
        if self.old:
            old = self.old
            self.new.update((p, old[p]) for p in unknown if p in old)
            unknown = [p for p in unknown if p not in old]
        # Where the pre-tokenizer parts letters from a mark after them, and the normaliser
        # ignores the case of ASCII letters, such pieces share one count.
        core_of: dict[bytes, tuple[bytes, bytes]] = {}
        plain = []
        for p in unknown:
            m = self.folds and _LETTERS_AND_MARK.fullmatch(p)
            if m and (low := (m[1].lower(), m[2])) != (p, b""):
                core_of[p] = low
            else:
                plain.append(p)
        needed = {x for pair in core_of.values() for x in pair if x}
        needed.update(plain)
        self._encode([p for p in needed if p not in self.new])
        self.new.update((p, self.new[a] + (self.new[b] if b else 0)) for p, (a, b) in core_of.items())


_LETTERS_AND_MARK = re.compile(rb"([A-Za-z]+)([.,]?)")


def count_batch(tokenizer, memo: PieceMemo, texts: list[bytes], chunk: int, overlap: int) -> list[int]:
    def offsets(part: str) -> list[int]:
        return [a for a, _ in tokenizer.encode(part, add_special_tokens=False).offsets]

    counts, split = [0] * len(texts), {}
    for i, raw in enumerate(texts):
        if len(raw) > chunk and len(text := raw.decode()) > chunk:
            counts[i] = spliced_count(offsets, text, chunk, overlap)
        else:
            split[i] = raw.split()  # bytes: ASCII white space only
    memo.learn({p for pieces in split.values() for p in pieces})
    known = memo.new.__getitem__
    for i, pieces in split.items():
        counts[i] = sum(map(known, pieces))
    return counts


_LOADED: dict[str, tuple] = {}


def _load(key: str, content: str):
    """The worker's tokenizer and memo (kept between the tasks of one worker)."""
    if key not in _LOADED:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        _LOADED.clear()
        _LOADED[key] = (tokenizer, PieceMemo(tokenizer))
    return _LOADED[key]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_bytes, n_tokens, over_limit``.

    The counts equal those of the library for the whole text: no begin, end or added
    special tokens; special strings in a text are special tokens, as is its default.
    The tokenizer must part words at white space (``tokenizer_path``, a ``tokenizers``
    JSON file on the driver, a few MB; its content is broadcast); one that does not, on
    trials, is a ValueError.

    NULL or empty text: 0 bytes, 0 tokens, not over the limit.  Repeated rows and NULL
    ids give a row each.  Other columns are not read.  Empty input: empty output.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    if not parts_at_blanks(_load(f"{tokenizer_path}:{len(content)}", content)[0]):
        raise ValueError(f"the tokenizer of {tokenizer_path} does not part words at white space")
    model = spark.sparkContext.broadcast(content)
    key = f"{tokenizer_path}:{len(content)}"
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, memo = _load(key, model.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            counts, at = [], 0
            lengths = sizes.to_pylist()
            while at < len(lengths):
                stop, held = at, 0
                while stop < len(lengths) and (stop == at or held + lengths[stop] <= SLICE_BYTES):
                    held += lengths[stop]
                    stop += 1
                part = texts.slice(at, stop - at).cast(pa.large_binary()).to_pylist()
                counts += count_batch(tokenizer, memo, [x or b"" for x in part], chunk_chars, overlap_chars)
                at = stop
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([ids, sizes, n, pc.greater(n, limit)], names=out.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, out)
