"""Tokenizing, packing token streams into fixed shards, auditing them, sampling training windows, and tokenizer metrics."""

from __future__ import annotations

import functools
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import word_tokens
from corpusloom.operators.aggregates import quantile_higher
from corpusloom.operators.windows import prefix_sums
from corpusloom.session import store

# Fixed values.
#: Largest token id of each storage type.
DTYPE_LIMITS = {"uint16": 0xFFFF, "uint32": 0xFFFFFFFF}


@functools.lru_cache(maxsize=4)
def _load(source: str):
    """A tokenizer from a JSON file or from JSON text; one per worker process."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(source) if source.lstrip().startswith("{") else Tokenizer.from_file(source)
    made.encode_special_tokens = True
    return made


def encode(df: DataFrame, tokenizer: str, text: str = "text", name: str = "ids", batch: int = 128) -> DataFrame:
    """Adds the token ids of every text (null for null), encoded in batches; ``tokenizer`` is a JSON file on every machine, or JSON. Only the text column crosses into Python."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(column: pa.Array) -> pa.Array:
        tok, texts, ids = _load(tokenizer), column.to_pylist(), []
        for i in range(0, len(texts), batch):
            ids += [e.ids for e in tok.encode_batch([t or "" for t in texts[i : i + batch]], add_special_tokens=False)]
        return pa.array([None if t is None else x for t, x in zip(texts, ids)], pa.list_(pa.int32()))

    return df.withColumn(name, run.asNondeterministic()(F.col(text)))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text of token ids."""

    @F.arrow_udf(T.StringType())
    def run(column: pa.Array) -> pa.Array:
        tok = _load(tokenizer)
        return pa.array([None if x is None else tok.decode(x, skip_special_tokens=False) for x in column.to_pylist()], pa.string())

    return df.withColumn(name, run.asNondeterministic()(F.col(ids)))


def round_trip_failures(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Rows whose text doesn't come back exactly from its ids."""
    return decode(encode(df, tokenizer, text), tokenizer).filter(~F.col("decoded").eqNullSafe(F.col(text)))


def bad_ids(df: DataFrame, ids: str = "ids", *, dtype: str = "uint16", vocabulary: int | None = None) -> DataFrame:
    """Rows with an id below 0, beyond the storage type, or outside the vocabulary."""
    limit = DTYPE_LIMITS[dtype] if vocabulary is None else min(DTYPE_LIMITS[dtype], vocabulary - 1)
    return df.filter((F.array_max(ids) > limit) | (F.array_min(ids) < 0))


def token_offsets(df: DataFrame, order: list[str], length: Column, *, eos: bool = True, group: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens`` (with the end token) and ``offset``: where each document begins in the stream of its group. Documents without tokens still have their end token."""
    n = F.coalesce(length, F.lit(0)).cast("long") + int(eos)
    return prefix_sums(df.withColumn("n_tokens", n), order, {"offset": F.col("n_tokens")}, group)


def shard_pieces(offsets: DataFrame, shard_size: int, *, keep: list[str]) -> DataFrame:
    """The pieces of documents in shards of an exact size: (keep, shard_index, place, start, length); a document goes on in the next shard where one is full."""
    first, last = F.floor(F.col("offset") / shard_size), F.floor((F.col("offset") + F.col("n_tokens") - 1) / shard_size)
    rows = offsets.filter("n_tokens > 0").select(*keep, "offset", "n_tokens", F.explode(F.sequence(first, last)).alias("shard_index"))
    lo = F.greatest(F.col("offset"), F.col("shard_index") * shard_size)
    hi = F.least(F.col("offset") + F.col("n_tokens"), (F.col("shard_index") + 1) * shard_size)
    return rows.select(*keep, "shard_index", (lo - F.col("shard_index") * shard_size).alias("place"), (lo - F.col("offset")).alias("start"), (hi - lo).alias("length"))


def shard_statistics(offsets: DataFrame, shard_size: int, group: list[str] | None = None) -> DataFrame:
    """Tokens and pieces of every shard, without the tokens themselves."""
    return shard_pieces(offsets, shard_size, keep=group or []).groupBy(*(group or []), "shard_index").agg(F.sum("length").alias("num_tokens"), F.count("*").alias("pieces"))


def build_shards(df: DataFrame, order: list[str], shard_size: int, *, ids: str = "ids", eos_id: int | None = 1, group: list[str] | None = None, dtype: str = "uint16", keep_ids: bool = True) -> DataFrame:
    """Token shards of an exact size, as rows (group, shard_index, ids, num_tokens, payload, byte_size, sha256).

    Every document is followed by the end token, if one is given; the stream is cut at exact multiples of the shard size. A shard is put
    together from its pieces in one task, and is as large as the size says. ``payload`` has the ids as little-endian integers.
    """
    group = group or []
    whole = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    whole = whole if eos_id is None else F.concat(whole, F.array(F.lit(eos_id)))
    keys = [*group, *order]
    tmp = [f"_k{i}" for i in range(len(keys))]
    # offsets come from lengths alone; the ids move to their pieces and then to their shards
    lengths = df.select(*[F.col(c).alias(k) for c, k in zip(keys, tmp)], F.size(whole).alias("_n"))
    placed = token_offsets(lengths, tmp[len(group) :], F.col("_n"), eos=False, group=tmp[: len(group)])
    pieces = shard_pieces(placed, shard_size, keep=tmp)
    on = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(keys, tmp)]
    pieces = df.select(*keys, whole.alias("_ids")).join(pieces, on).drop(*tmp)
    piece = F.slice("_ids", F.col("start").cast("int") + 1, F.col("length").cast("int"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("place", piece.alias("part")))), lambda x: x["part"])
    shards = pieces.groupBy(*group, "shard_index").agg(F.flatten(parts).alias("ids")).withColumn("num_tokens", F.size("ids").cast("long"))
    return pack_bytes(shards, dtype, keep_ids)


def pack_bytes(shards: DataFrame, dtype: str = "uint16", keep_ids: bool = True) -> DataFrame:
    """Adds ``payload, byte_size, sha256`` to shards of ids, which are dropped unless kept. Ids that don't fit the type are an error. With large shards set
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` to 1."""
    limit, width = DTYPE_LIMITS[dtype], 2 if dtype == "uint16" else 4
    schema = T.StructType([*[f for f in shards.schema.fields if keep_ids or f.name != "ids"], T.StructField("payload", T.BinaryType())])
    at = shards.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            lists = b.column(at)
            flat, ends, out = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(), []
            for lo, hi in zip(ends, ends[1:]):  # slices of one array; no id becomes a Python object
                a = flat[lo:hi]
                if len(a) and (a.min() < 0 or a.max() > limit):
                    raise ValueError(f"token id out of range for {dtype}")
                out.append(a.astype(f"<u{width}").tobytes())
            columns = [c for i, c in enumerate(b.columns) if keep_ids or i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], [f.name for f in schema])

    return shards.mapInArrow(run, schema).withColumn("byte_size", F.octet_length("payload").cast("long")).withColumn("sha256", F.sha2("payload", 256))


def shard_audit(shards: DataFrame, eos_id: int, group: list[str] | None = None, vocabulary: int | None = None) -> DataFrame:
    """Tokens, end tokens (one per document), largest id, and whether all ids are in the vocabulary."""
    ends = F.size(F.filter("ids", lambda x: x == eos_id))
    out = shards.groupBy(*(group or [])).agg(F.count("*").alias("shards"), F.sum(F.size("ids")).alias("total_tokens"), F.sum(ends).alias("eos_tokens"), F.max(F.array_max("ids")).alias("max_id"))
    return out if vocabulary is None else out.withColumn("in_vocabulary", F.coalesce(F.col("max_id") < vocabulary, F.lit(True)))


def next_token_pairs(shards: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, position, x, y): every token with the one after it in its shard."""
    pairs = F.arrays_zip(F.slice("ids", 1, F.greatest(F.size("ids") - 1, F.lit(0))).alias("x"), F.slice("ids", 2, F.greatest(F.size("ids") - 1, F.lit(0))).alias("y"))
    return shards.select(*keep, F.posexplode(pairs).alias("position", "_p")).select(*keep, "position", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))


def sample_windows(shards: DataFrame, context: int, count: int, seed: int, step: int = 0, *, key: str = "shard_index", size: str = "num_tokens") -> DataFrame:
    """``count`` training windows: (draw, key, start), shards drawn in proportion to their tokens beyond the context, starts uniform.

    Draw i of a step is a hash of (seed, step, i), so a sampler needs no state. Only shards with more than ``context`` tokens take part, and starts
    are drawn from a half-open range, so the last legal one isn't drawn; a shard of context + 1 tokens has no start and is left out.
    """
    usable = prefix_sums(shards.filter(F.col(size) > context + 1).select(key, (F.col(size) - context).alias("_w")), [key], {"_from": F.col("_w")})
    total = usable.agg(F.sum("_w").alias("_total"))
    uniform = lambda salt: (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(step), "draw", F.lit(salt)), 11)) / float(1 << 53)
    spark = shards.sparkSession
    draws = spark.range(count).withColumnRenamed("id", "draw").join(F.broadcast(total), F.lit(True)).withColumn("_at", F.floor(uniform(0) * F.col("_total")).cast("long"))
    # cells of equal width hold few shards each, since a shard has at most as many tokens as its size; a shard lies in all cells that it covers
    width = F.greatest(F.lit(1), F.ceil(F.col("_widest"))).cast("long")
    widest = usable.agg(F.max("_w").alias("_widest"))
    usable = usable.join(F.broadcast(widest), F.lit(True))
    cells = usable.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_from") + F.col("_w") - 1) / width))))
    draws = draws.join(F.broadcast(widest), F.lit(True)).withColumn("_cell", F.floor(F.col("_at") / width)).drop("_widest")
    found = draws.join(cells, "_cell").filter((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_from") + F.col("_w")))
    return found.select("draw", key, F.floor(uniform(1) * (F.col("_w") - 1)).cast("long").alias("start"))


def tokenizer_metrics(encoded: DataFrame, by: list[str] | None = None, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """Documents, tokens, bytes, words, tokens per word over all, and the median and 95th percentile per document (higher rank), by each single
    dimension and over all. ``dimension`` is ``all`` or the column's name, ``value`` its value."""
    rows = encoded.select(*(by or []), F.size(ids).cast("long").alias("t"), F.octet_length(text).cast("long").alias("b"), F.size(word_tokens(F.col(text))).cast("long").alias("w"))
    rows = store(rows.withColumn("r", F.col("t") / F.greatest(F.col("w"), F.lit(1))), "token-figures")  # texts are encoded once; sums and quantiles read narrow rows
    pairs = [F.struct(F.lit("all").alias("dimension"), F.lit(None).cast("string").alias("value")), *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in by or []]]
    long = rows.select("t", "b", "w", "r", F.explode(F.array(*pairs)).alias("k")).select("k.*", "t", "b", "w", "r").filter("dimension = 'all' or value is not null")
    sums = long.groupBy("dimension", "value").agg(F.count("*").alias("documents"), F.sum("t").alias("tokens"), F.sum("b").alias("utf8_bytes"), F.sum("w").alias("words"))
    tails = quantile_higher(long, "r", {"p50_tokens_per_word": 0.5, "p95_tokens_per_word": 0.95}, ["dimension", "value"]).drop("n").withColumnsRenamed({"dimension": "_d", "value": "_v"})
    out = sums.join(tails, (F.col("dimension") == F.col("_d")) & F.col("value").eqNullSafe(F.col("_v"))).drop("_d", "_v")
    return out.withColumn("tokens_per_word", F.col("tokens") / F.greatest(F.col("words"), F.lit(1)))


def fertility(probes: DataFrame, tokenizer: str, *, group: str = "group", text: str = "text") -> DataFrame:
    """Per probe group: texts, characters, words, tokens, tokens per word and characters per token. A probe that is empty, has no word or doesn't come back exactly is an error."""
    rows = decode(encode(probes, tokenizer, text), tokenizer).withColumn("_w", F.size(word_tokens(F.col(text))))
    bad = F.coalesce((F.col(text) == "") | (F.col("_w") < 1) | (F.col("decoded") != F.col(text)), F.lit(True))
    rows = rows.withColumn("_w", F.when(bad, F.raise_error(F.concat(F.lit("unusable probe: "), F.coalesce(F.col(text), F.lit("null")))).cast("int")).otherwise(F.col("_w")))
    sums = rows.groupBy(group).agg(F.count("*").alias("text_count"), F.sum(F.length(text)).alias("characters"), F.sum("_w").alias("words"), F.sum(F.size("ids")).alias("tokens"))
    return sums.withColumn("tokens_per_word", F.col("tokens") / F.col("words")).withColumn("characters_per_token", F.col("characters") / F.col("tokens"))


# Fixed value.
#: How a byte-level tokenizer cuts text before its merges.
PRETOKEN = r"('(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"


def pretoken_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(piece, count): the distributed first stage of byte-pair training. Put together, a text's pieces are the text."""
    pieces = F.regexp_extract_all(F.col(text), F.lit("(?U)" + PRETOKEN), F.lit(1))
    return df.select(F.explode(pieces).alias("piece")).groupBy("piece").agg(F.count("*").alias("count"))


def train_bpe(df: DataFrame, text: str = "text", *, vocabulary: int = 8192, min_count: int = 2, special: tuple[str, ...] = ("<|pad|>", "<|eos|>", "<|bos|>", "<|unk|>"), max_pieces: int = 2_000_000) -> str:
    """A byte-level byte-pair tokenizer as JSON. Counting pieces is distributed; merging runs on the driver over the distinct pieces with at least
    ``min_count`` occurrences, which may be no more than ``max_pieces``: beyond that it is an error, and ``min_count`` is to be raised (the tokenizer still encodes every text). Every piece weighs its full count, whatever the size of the input. Ties of counts go by piece, those of pairs by id."""
    from tokenizers import AddedToken, Tokenizer, decoders, models, pre_tokenizers

    counted = store(pretoken_counts(df, text).filter(F.col("count") >= min_count), "pieces")
    if (n := counted.count()) > max_pieces:
        raise ValueError(f"{n} distinct pieces occur {min_count} times or more, and {max_pieces} may be merged on the driver: raise min_count")
    top = counted.orderBy(F.col("count").desc(), "piece")
    vocab, merges = _merge_pairs(((r["piece"], r["count"]) for r in top.toLocalIterator()), vocabulary, special)
    tok = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    tok.pre_tokenizer, tok.decoder = pre_tokenizers.ByteLevel(add_prefix_space=False), decoders.ByteLevel()
    tok.add_special_tokens([AddedToken(t, special=True, normalized=False) for t in special])
    return tok.to_str()


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _merge_pairs(counted: Iterable[tuple[str, int]], vocabulary: int, special: tuple[str, ...]) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """Vocabulary and merges from (piece, count): the pair with the largest sum of counts is merged next, of equal ones that with the smallest ids."""
    letters = _byte_letters()
    tokens = list(dict.fromkeys([*special, *sorted(letters)]))
    ids = {t: i for i, t in enumerate(tokens)}
    first = [ids[c] for c in letters]
    words, weights = [], []
    sums, where = defaultdict(int), defaultdict(set)
    for piece, count in counted:
        word = [first[b] for b in piece.encode("utf-8", "surrogatepass")]
        if len(word) > 1:
            for pair in zip(word, word[1:]):
                sums[pair] += count
                where[pair].add(len(words))
            words.append(word)
            weights.append(count)
    heap = [(-n, pair) for pair, n in sums.items()]
    heapq.heapify(heap)
    merges: dict[tuple[int, int], None] = {}
    while heap and len(tokens) < vocabulary:
        n, pair = heapq.heappop(heap)
        now = sums.get(pair, 0)
        if now != -n:  # sums that fell since; those that rose were pushed again
            if 0 < now < -n:
                heapq.heappush(heap, (-now, pair))
            continue
        name = tokens[pair[0]] + tokens[pair[1]]
        if name not in ids:
            ids[name] = len(tokens)
            tokens.append(name)
        merges.setdefault(pair)
        made, risen = ids[name], set()
        for w in where.pop(pair):
            old, new, i = words[w], [], 0
            while i < len(old):
                both = i + 1 < len(old) and (old[i], old[i + 1]) == pair
                new.append(made if both else old[i])
                i += 2 if both else 1
            if len(new) == len(old):
                continue
            for p in zip(old, old[1:]):
                sums[p] -= weights[w]
            for p in zip(new, new[1:]):
                sums[p] += weights[w]
                if made in p:
                    where[p].add(w)
                    risen.add(p)
            words[w] = new
        for p in risen:
            heapq.heappush(heap, (-sums[p], p))
    return ids, [(tokens[a], tokens[b]) for a, b in merges]
