"""Splitting oversized texts at natural boundaries, chosen by lexical cohesion."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import kernels as K

#: Ends of paragraphs, lines and sentences: a cut may lie after any of these.
_ENDS = re.compile(r"\n[^\S\n]*(?:\n\s*)?|(?:(?<=[.!?])|(?<=[.!?][\"')\]»”’]))[^\S\n]+|(?<=[。！？])")
_BLANKS = re.compile(r"\s+")
_WORDS = re.compile(f"[^\\W_{K.HAN}]+|[{K.HAN}]")


def boundaries(text: str) -> np.ndarray:
    """Places between characters where a paragraph, a line or a sentence has ended."""
    ends = np.array([m.end() for m in _ENDS.finditer(text)], np.int64)
    return ends[(ends > 0) & (ends < len(text))]


def likeness(text: str, places: np.ndarray, block: int) -> np.ndarray:
    """At each of the rising places in a text, the cosine of the word counts of the ``block`` words before and after; 0 at the ends of the text."""
    starts, numbers, ids = [], [], {}
    for m in _WORDS.finditer(text):
        starts.append(m.start())
        numbers.append(ids.setdefault(m.group().lower(), len(ids)))
    starts, numbers = np.array(starts, np.int64), np.array(numbers, np.int64)
    out = np.zeros(len(places))
    for at in range(0, len(places), 256):  # counts of a bounded number of places at a time
        mid = np.searchsorted(starts, places[at : at + 256])
        lo, hi = np.maximum(mid - block, 0), np.minimum(mid + block, len(numbers))
        first = int(lo[0])
        names, local = np.unique(numbers[first : hi[-1]], return_inverse=True)
        if not len(names):
            continue
        rows, back = np.unique(np.concatenate([lo, mid, hi]) - first, return_inverse=True)
        # words before each of the rows, by word
        row = np.searchsorted(rows, np.arange(len(local)), "right")
        counts = np.bincount(row * len(names) + local, minlength=(len(rows) + 1) * len(names)).reshape(len(rows) + 1, len(names))
        before = np.cumsum(counts, axis=0, dtype=np.float32)[:-1]
        l_, m_, h_ = (before[i] for i in back.reshape(3, -1))
        left, right = m_ - l_, h_ - m_
        norm = np.sqrt((left**2).sum(axis=1) * (right**2).sum(axis=1))
        out[at : at + 256] = (left * right).sum(axis=1) / np.maximum(norm, 1e-9)
    return out


def depths(curve: np.ndarray) -> np.ndarray:
    """How far each value lies below the peaks to its left and right."""
    out = np.zeros(len(curve))
    values = curve.tolist()
    for order in (range(len(values)), range(len(values) - 1, -1, -1)):
        peak, last = -1.0, float("inf")
        for i in order:  # the peak is the top of the last rise on this side
            peak = max(peak, values[i]) if values[i] <= last else values[i]
            last = values[i]
            out[i] += peak - last
    return out


def split_text(text: str, limit: int = 1500, overlap: int = 100, block: int = 100, rank_file: str = K.RANK_FILE) -> list[tuple[int, int, int]]:
    """Pieces of a text as (start, end, tokens), in characters of the text; one piece if it has at most ``limit`` tokens.

    Within the second half of the room a piece has, the cut is made at the paragraph, line or sentence end in the deepest
    valley of lexical cohesion; without such an end there, at the last one before; else at the last blank in the room, else
    between characters. The next piece begins ``overlap`` tokens before the cut. Every piece is counted on its own, and its cut
    moved back if cutting inside a word has added tokens.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    enc = K.tokenizer(rank_file)
    ids = enc.encode_ordinary(text)
    if len(ids) <= limit:
        return [(0, len(text), len(ids))]
    token_ends = np.cumsum(K.token_bytes(rank_file)[np.array(ids)])
    # byte place of every character; a token may end inside a character
    widths = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    char_starts = np.concatenate([[0], np.cumsum(1 + (widths > 0x7F) + (widths > 0x7FF).astype(np.int64) + (widths > 0xFFFF))])
    to_char = lambda byte: int(np.searchsorted(char_starts, byte, "right") - 1)
    tokens_before = lambda char: int(np.searchsorted(token_ends, char_starts[char], "right"))
    ends = boundaries(text)
    blanks = np.array([m.end() for m in _BLANKS.finditer(text)], np.int64)
    depth = depths(likeness(text, ends, block))
    pieces, start = [], 0
    while True:
        room = limit
        while True:
            first = tokens_before(start) if start else 0
            last = first + room
            if last >= len(ids):
                end = len(text)
            else:
                top, floor = to_char(token_ends[last - 1]), to_char(token_ends[first + room // 2])
                i, j = np.searchsorted(ends, floor), np.searchsorted(ends, top, "right")
                least = to_char(token_ends[min(first + 2 * overlap, last - 1)])
                if i < j:
                    end = int(ends[i + int(np.argmax(depth[i:j]))])
                elif j and ends[j - 1] > least:
                    end = int(ends[j - 1])
                else:
                    k = int(np.searchsorted(blanks, top, "right"))
                    end = int(blanks[k - 1]) if k and blanks[k - 1] > least else max(top, start + 1)
            size = len(enc.encode_ordinary(text[start:end]))
            if size <= limit or room <= 2 * overlap + 1:
                break
            room -= max(1, size - limit)
        pieces.append((start, end, size))
        if end >= len(text):
            return pieces
        mark = tokens_before(end) - overlap
        start = max(to_char(token_ends[mark - 1]) if mark > 0 else 0, start + 1)


def split_documents(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1500,
    overlap: int = 100,
    block: int = 100,
    rank_file: str = K.RANK_FILE,
) -> DataFrame:
    """Pieces of at most ``limit`` tokens of every document; see :func:`split_text`.

    Returns ``doc_id, piece, pieces, start, end, tokens, text``: one row per piece, ``start`` and ``end`` in characters of the
    raw text, whose slice is ``text``; ``tokens`` is the piece's own count. A document within the limit is one piece. One pass
    without a shuffle; the work per text is linear.

    Null texts give no rows; an empty text is one empty piece. Repeated rows give repeated pieces. An empty table gives no rows.
    Other columns are ignored.
    """
    names = ["doc_id", "piece", "pieces", "start", "end", "tokens", "text"]
    kinds = [pa.int64(), *[pa.int32()] * 2, *[pa.int64()] * 3, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                pieces = split_text(text, limit, overlap, block, rank_file)
                rows += [(doc, i, len(pieces), s, e, n, text[s:e]) for i, (s, e, n) in enumerate(pieces)]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return documents.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, piece int, pieces int, start long, end long, tokens long, text string")
