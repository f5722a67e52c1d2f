"""Evaluation texts leaking into training text: one automaton over the word runs of all items, one scan of the corpus."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import nfkc
from corpusloom.llm import kernels as K

_AUTOMATA: dict = {}


def runs_of(passage: str, min_words: int, whole_from: int | None = None) -> list[str]:
    """Every run of ``min_words`` words of a passage, as it stands in a text of words set between blanks. A shorter passage of at least ``whole_from`` words is one run."""
    words = K.words_of(nfkc(passage))
    if len(words) < min_words:
        return [f" {' '.join(words)} "] if whole_from and len(words) >= whole_from else []
    return [f" {' '.join(words[i : i + min_words])} " for i in range(len(words) - min_words + 1)]


def _automaton(key: str, items: list[tuple[int, list[str]]], min_words: int, whole_from: int | None):
    """One automaton per worker process and set of passages."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        patterns: dict[str, set[int]] = {}
        for item, passages in items:
            for passage in passages:
                for pattern in runs_of(passage, min_words, whole_from):
                    patterns.setdefault(pattern, set()).add(item)
        a = ahocorasick.Automaton()
        for pattern, owners in patterns.items():
            a.add_word(pattern, (len(pattern), sorted(owners)))
        if patterns:
            a.make_automaton()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


def word_spans(text: str) -> list[tuple[int, int]] | None:
    """Start and end in the raw text of every word, in the order of :func:`kernels.words_of`.

    The text is normalized piece by piece, a piece being a character with the marks that combine with it. None where
    that isn't the normal form of the whole, as with marks that compose across pieces.
    """
    flat, origin, i = [], [], 0
    while i < len(text):
        j = i + 1
        while j < len(text) and (unicodedata.combining(text[j]) or 0x1160 <= ord(text[j]) <= 0x11FF):
            j += 1
        piece = nfkc(text[i:j]).lower()
        flat.append(piece)
        origin += [(i, j)] * len(piece)
        i = j
    whole = "".join(flat)
    if whole != nfkc(text).lower():
        return None
    return [(origin[m.start()][0], origin[m.end() - 1][1]) for m in K.WORD.finditer(whole)]


def _scan(text: str, automaton) -> dict[int, tuple[int, int, int]]:
    """For every item found: first word, last word (exclusive) of its longest run in the text, and words found in all."""
    words = K.words_of(nfkc(text))
    joined = f" {' '.join(words)} "
    at: dict[int, list[tuple[int, int]]] = {}
    for end, (length, owners) in automaton.iter(joined):
        for owner in owners:
            at.setdefault(owner, []).append((end - length + 1, end))
    if not at:
        return {}
    blanks, n = {0: 0}, 0  # the blank before word k is at blanks[k]; every pattern begins and ends with one
    for k, w in enumerate(words):
        n += len(w) + 1
        blanks[n] = k + 1
    out = {}
    for owner, places in at.items():
        runs: list[list[int]] = []
        for s, e in sorted(places):
            first, last = blanks[s], blanks[e]
            if runs and first == runs[-1][2] + 1 and last == runs[-1][1] + 1:
                runs[-1][1:] = [last, first]
            else:
                runs.append([first, last, first])
        first, last, _ = max(runs, key=lambda r: (r[1] - r[0], -r[0]))
        covered, upto = 0, 0
        for r in runs:  # they begin in rising order
            covered += max(0, r[1] - max(r[0], upto))
            upto = max(upto, r[1])
        out[owner] = (first, last, covered)
    return out


def leaked_passages(
    documents: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_cols: tuple[str, ...] = ("prompt",),
    min_words: int = 12,
    whole_from: int | None = None,
    max_nodes: int = 4_000_000,
) -> DataFrame:
    """Documents that hold ``min_words`` or more consecutive words of an evaluation item's passages.

    All runs of ``min_words`` normalized words of the items make one Aho-Corasick automaton, through which every text
    goes once; there is no join and no shuffle. Passages shorter than that count where they stand whole if they have at
    least ``whole_from`` words (null: they don't count). ``passage_cols`` are strings or arrays of strings, as questions
    and answers.

    The items are a fixed set of tests. Their passages, not the patterns, come to the driver and go to the workers, in blocks whose
    automata have at most ``max_nodes`` nodes (some 50 bytes each, per worker process), all passages of an item in one block: each block
    is one scan of the corpus, and the rows are the same however many there are. An item that alone is larger makes a block of its own.

    Returns ``doc_id, item_id, words`` (the longest run), ``covered_words`` (words of the text in any run), and ``start,
    end``: where that longest run stands in the raw text (null where combining marks leave no exact place).

    Null texts, items and passages, and passages too short to count, give no rows. Repeated items count once, the passages of rows with
    the same item together; repeated document rows give repeated rows. Empty tables give no rows. Other columns are ignored.
    """
    schema = "doc_id long, item_id long, words int, covered_words int, start int, end int"
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {f.name: f.dataType.typeName() for f in items.schema}
    each = [F.col(c) if kinds[c] == "array" else F.array(c) for c in passage_cols]
    passages = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in each]).alias("p"))
    passages = passages.groupBy("item").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("p")))).alias("p")).orderBy("item")
    spark = documents.sparkSession
    out = None

    def scan(block: list[tuple[int, list[str]]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)
        key = hashlib.sha256(repr((block, min_words, whole_from)).encode("utf-8", "surrogatepass")).hexdigest()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(key, shared.value, min_words, whole_from)
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if not text or not len(automaton):
                        continue
                    found = _scan(text, automaton)
                    spans = word_spans(text) if found else None
                    for item, (first, last, covered) in found.items():
                        place = (spans[first][0], spans[last - 1][1]) if spans is not None else (None, None)
                        rows.append((doc, item, last - first, covered, *place))
                columns = list(zip(*rows)) if rows else [[]] * 6
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], ["doc_id", "item_id", "words", "covered_words", "start", "end"])

        return docs.mapInArrow(run, schema)

    block, nodes = [], 0
    for row in passages.toLocalIterator():
        texts = [p for p in row.p if p]
        size = sum(len(p) for t in texts for p in runs_of(t, min_words, whole_from))
        if block and nodes + size > max_nodes:
            hits = scan(block)
            out = hits if out is None else out.unionByName(hits)
            block, nodes = [], 0
        if size:
            block.append((row.item, texts))
            nodes += size
    hits = scan(block)
    return hits if out is None else out.unionByName(hits)
