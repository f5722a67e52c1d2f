"""Deduplicating new batches against all history with a prefix-tree hash forest.

Every text has one label per tree: ``DEPTH`` min-wise n-gram hashes of ``BITS`` bits each, the first in the highest bits, so
that texts with a common prefix of hashes lie side by side in the sorted order of a tree. A run of the forest is a
stored table of (tree, stem, rest, id, n), bucketed by tree and stem (the shortest prefix that is ever searched) and sorted by stem and
rest, that is by label: a search moves the few labels of the batch, never the history. Runs, signatures and a manifest lie in one
folder, so that another session can open the forest and go on.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import nfkc, tidy
from corpusloom.llm import kernels as K
from corpusloom.llm.overlap import gram_sets, only, verify
from corpusloom.session import discard, new_path, store
from corpusloom.sources.paths import exists, read_bytes, remove, write_bytes

BITS, DEPTH = 12, 5


def labels_of(grams: np.ndarray, trees: int) -> np.ndarray:
    """One non-negative 64-bit label per tree; none for a text without n-grams."""
    if not len(grams):
        return np.empty(0, np.int64)
    low = K.mix(K.min_hashes(grams, trees * DEPTH)).reshape(trees, DEPTH) >> np.uint64(64 - BITS)
    label = np.zeros(trees, np.uint64)
    for i in range(DEPTH):
        label = (label << np.uint64(BITS)) | low[:, i]
    return label.view(np.int64)


def sign(texts: DataFrame, ngram: int, trees: int) -> DataFrame:
    """(id, sha, n, labels) of rows (id, text, *others), in one pass without a shuffle; ``sha`` is the hex SHA-256 of the
    normalized text. Null texts keep their row, with nulls. The other columns stay as they are."""
    others = [f for f in texts.schema if f.name not in ("id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, sizes, labels = [], [], []
            for text in batch.column("text").to_pylist():
                if text is None:
                    shas.append(None), sizes.append(None), labels.append(None)
                    continue
                plain = nfkc(text)
                grams = K.ngram_hashes(K.words_of(plain), ngram)
                shas.append(hashlib.sha256(tidy(plain).encode("utf-8", "surrogatepass")).hexdigest())
                sizes.append(len(grams))
                labels.append(labels_of(grams, trees))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[batch.column(f.name) for f in others], pa.array(shas, pa.string()), pa.array(sizes, pa.int32()), pa.array(labels, pa.list_(pa.int64()))],
                ["id", *[f.name for f in others], "sha", "n", "labels"],
            )

    rest = "".join(f", {f.name} {f.dataType.simpleString()}" for f in others)
    return texts.select("id", "text", *[f.name for f in others]).mapInArrow(run, f"id long{rest}, sha string, n int, labels array<long>")


def entries(signed: DataFrame, depth: int) -> DataFrame:
    """(tree, stem, rest, id, n), one row per tree: the label's first ``depth`` hashes and those after."""
    low = BITS * (DEPTH - depth)
    rows = signed.select("id", "n", F.posexplode("labels").alias("tree", "label"))
    return rows.select("tree", F.shiftright("label", low).alias("stem"), F.col("label").bitwiseAND((1 << low) - 1).cast("int" if low < 32 else "long").alias("rest"), "id", "n")


def alike(a: Column, b: Column) -> Column:
    """The number of equal hashes in two texts' labels: an estimate of their similarity."""
    same = lambda acc, x: acc + sum(((F.shiftright(x, BITS * j).bitwiseAND((1 << BITS) - 1)) == 0).cast("int") for j in range(DEPTH))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), same)


@dataclass
class HashForest:
    """Runs of accepted texts, by kind (``documents``, ``incoming`` ...): a kind names where the texts of its ids are.

    ``recall`` is the probability with which a search at its widest finds a pair of the given ``similarity``, more similar pairs being found
    with more. It fixes how many trees there are: as many as reach it with prefixes of ``shortest`` hashes. A search begins with whole
    labels (``DEPTH`` hashes), which find most pairs; for records without a partner prefixes widen until the recall is reached.

    A bucket that holds more than ``hot`` entries, as a large group of near-copies makes them, keeps ``heads`` of them in its run, and the
    others in a table of tails that is spread by a salt. Tails are searched too, for records that nothing else has settled: a record
    of such a group is settled by a head, so a large group meets a batch as a few entries, and nothing is left out. Hot buckets
    are told by one in ``sample`` records; what the sample misses is searched as usual.

    ``path`` is the forest's folder, in the shared folder unless given; :meth:`open` opens one that is there.
    """

    spark: SparkSession
    ngram: int = 3
    similarity: float = 0.6
    recall: float = 0.9999
    shortest: int = 3
    max_runs: int = 4
    hot: int = 2000
    heads: int = 8
    sample: int = 32
    salts: int = 32
    path: str = ""
    runs: list[tuple[str, str, str, int]] = field(default_factory=list)
    signatures: list[tuple[str, str]] = field(default_factory=list)
    tails: list[tuple[str, str]] = field(default_factory=list)
    fresh: list[str] = field(default_factory=list)

    _KEPT = ("ngram", "similarity", "recall", "shortest", "max_runs", "hot", "heads", "sample", "salts", "runs", "signatures", "tails", "fresh")

    def __post_init__(self) -> None:
        self.path = self.path or new_path(self.spark, "forest")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> HashForest:
        """The forest of an earlier session: its runs are bucketed tables again, and nothing is signed anew."""
        kept = json.loads(read_bytes(spark, f"{path}/manifest.json"))
        forest = cls(spark, path=path, **{k: [tuple(x) if isinstance(x, list) else x for x in v] if isinstance(v, list) else v for k, v in kept.items()})
        rest = "int" if BITS * (DEPTH - forest.shortest) < 32 else "bigint"
        for _, name, place, buckets in forest.runs:
            if not spark.catalog.tableExists(name):
                spark.sql(f"CREATE TABLE {name} (tree INT, stem BIGINT, rest {rest}, id BIGINT, n INT) USING parquet CLUSTERED BY (tree, stem) SORTED BY (tree, stem, rest) INTO {buckets} BUCKETS LOCATION '{place}'")
        return forest

    def save(self) -> None:
        """Write the manifest; runs and signatures are stored already."""
        write_bytes(self.spark, f"{self.path}/manifest.json", json.dumps({k: getattr(self, k) for k in self._KEPT}).encode())

    @property
    def trees(self) -> int:
        return K.bands_for(self.similarity, self.shortest, self.recall)

    def reached(self, depth: int) -> float:
        """The probability with which prefixes of ``depth`` hashes find a pair at the similarity asked for."""
        return 1 - (1 - self.similarity**depth) ** self.trees

    def widths(self, recall: float | None = None) -> list[int]:
        """The depths searched one after another: whole labels, then prefixes two hashes shorter each time, down to the first that reaches the recall."""
        goal, out = self.recall if recall is None else recall, [DEPTH]
        while self.reached(out[-1]) < goal and out[-1] > self.shortest:
            out.append(max(self.shortest, out[-1] - 2))
        return out

    @property
    def floor(self) -> int:
        """So many equal hashes has all but one in 100,000 of the pairs at the similarity asked for."""
        n = self.trees * DEPTH
        return math.floor(n * self.similarity - 4.3 * math.sqrt(n * self.similarity * (1 - self.similarity)))

    def sign(self, texts: DataFrame) -> DataFrame:
        return sign(texts, self.ngram, self.trees)

    def keep(self, kind: str, signed: DataFrame) -> DataFrame:
        """Store (id, n, labels, ...) in the forest's folder; pairs located by the runs are compared by these labels first."""
        place = f"{self.path}/signatures-{uuid.uuid4().hex}"
        signed.write.parquet(place)
        self.signatures.append((kind, place))
        return self.spark.read.schema(signed.schema).parquet(place)

    def labels(self, kind: str) -> DataFrame | None:
        """(id, labels) of all texts of a kind."""
        places = [p for k, p in self.signatures if k == kind]
        return self.spark.read.schema("id long, labels array<long>").parquet(*places) if places else None

    def _part_hot(self, kind: str, signed: DataFrame, rows: DataFrame) -> DataFrame:
        """The entries for a run; those of hot buckets beyond their heads become tails."""
        some = signed.filter(F.pmod(F.xxhash64("id"), F.lit(self.sample)) == 0)
        hot = store(entries(some, self.shortest).groupBy("tree", "stem").agg(F.count("*").alias("c")).filter(F.col("c") > self.hot / self.sample).select("tree", "stem"), "hot")
        if hot.isEmpty():
            return rows
        full = store(rows.join(hot, ["tree", "stem"], "left_semi").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(self.salts)).cast("int")), "full")
        # heads of each part of a bucket, then of those: no task sees a whole bucket
        part, whole = Window.partitionBy("tree", "stem", "salt").orderBy("id"), Window.partitionBy("tree", "stem").orderBy("id")
        heads = full.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= self.heads).withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= self.heads).drop("r")
        heads = store(heads, "heads")
        place = f"{self.path}/tails-{uuid.uuid4().hex}"
        full.join(heads, ["tree", "stem", "id"], "left_anti").repartition("tree", "stem", "salt").write.parquet(place)
        self.tails.append((kind, place))
        return rows.join(hot, ["tree", "stem"], "left_anti").unionByName(heads.drop("salt"))

    def add(self, kind: str, signed: DataFrame) -> None:
        """Store accepted texts, whose labels are kept already, as a new run; with too many runs of a kind, merge them."""
        self._write(kind, self._part_hot(kind, signed, entries(signed, self.shortest)))
        mine = [r for r in self.runs if r[0] == kind]
        if len(mine) > self.max_runs:
            merged = self.spark.table(mine[0][1])
            for run in mine[1:]:
                merged = merged.unionByName(self.spark.table(run[1]))
            self._write(kind, merged)
            for run in mine:  # all searches of them are stored results by now
                self.runs.remove(run)
                self.spark.sql(f"DROP TABLE IF EXISTS {run[1]}")
                remove(self.spark, run[2])
        self.save()

    def _write(self, kind: str, rows: DataFrame) -> None:
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"corpusloom_run_{uuid.uuid4().hex}"
        place = f"{self.path}/{name}"
        rows.repartition(n, "tree", "stem").write.bucketBy(n, "tree", "stem").sortBy("tree", "stem", "rest").option("path", place).saveAsTable(name)
        self.runs.append((kind, name, place, n))

    def locate(self, signed: DataFrame, records: int, depth: int, kinds: tuple[str, ...] | None = None) -> DataFrame | None:
        """(id, kind, other): entries of the forest within the range of labels that share their first ``depth`` hashes with a label of the batch of ``records`` texts.

        Similarity can't exceed the ratio of the two sizes, so pairs whose sizes are further apart are left out. While the labels of the batch
        fit into the tasks' memory they are hashed and the runs stream by; a larger batch is sorted and merged with them.
        """
        probe = self._probe(signed, depth)
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if records * self.trees * 64 / partitions <= 32 << 20:
            probe = probe.hint("shuffle_hash")
        out = None
        for kind, name, _, _ in self.runs:
            if kinds is None or kind in kinds:
                hits = self._hits(kind, probe.join(self.spark.table(name), ["tree", "stem"]))
                out = hits if out is None else out.unionByName(hits)
        return None if out is None else out.distinct()

    def locate_tails(self, signed: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame | None:
        """The same among the tails of hot buckets, at the widest prefix, each label going to every part of its bucket."""
        out = None
        for kind, place in self.tails:
            if kinds is None or kind in kinds:
                rows = self.spark.read.parquet(place)
                probe = self._probe(signed, self.widths()[-1]).join(rows.select("tree", "stem").distinct(), ["tree", "stem"], "left_semi")
                probe = probe.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
                hits = self._hits(kind, probe.join(rows, ["tree", "stem", "salt"]))
                out = hits if out is None else out.unionByName(hits)
        return None if out is None else out.distinct()

    def _probe(self, signed: DataFrame, depth: int) -> DataFrame:
        step = 1 << (BITS * (DEPTH - depth))
        low = F.col("rest") - F.pmod(F.col("rest"), F.lit(step))
        return entries(signed, self.shortest).select("tree", "stem", low.alias("low"), (low + (step - 1)).alias("high"), F.col("id").alias("i"), F.col("n").alias("m"))

    def _hits(self, kind: str, joined: DataFrame) -> DataFrame:
        close = F.col("rest").between(F.col("low"), F.col("high")) & (F.least("n", "m") >= F.lit(self.similarity) * F.greatest("n", "m"))
        return joined.filter(close).select(F.col("i").alias("id"), F.lit(kind).alias("kind"), F.col("id").alias("other"))


def resolve(edges: DataFrame) -> DataFrame:
    """The cases among linked records: (id) of those with a link to a smaller id that is no case itself.

    ``edges`` has (lo, hi), lo < hi. Each round settles every record all of whose smaller links are settled; the rounds
    needed are the longest chain of links of rising ids, and their work shrinks with what is left.
    """
    cases = None
    edges = store(edges.select("lo", "hi").distinct(), "links")
    while not edges.isEmpty():
        his = edges.select(F.col("hi").alias("lo")).distinct()
        firsts = edges.select("lo").distinct().join(his, "lo", "left_anti")
        new = store(edges.join(firsts, "lo").select("hi").distinct(), "cases")
        cases = new if cases is None else cases.unionByName(new)
        left = edges.join(firsts, "lo", "left_anti").join(new, "hi", "left_anti").join(new.withColumnRenamed("hi", "lo"), "lo", "left_anti")
        old, edges = edges, store(left.select("lo", "hi"), "links")
        discard(old)
    return edges.select(F.col("hi").alias("id")).limit(0) if cases is None else cases.select(F.col("hi").alias("id")).distinct()


@dataclass
class BatchDeduper:
    """Marks new batches, each against everything accepted before it.

    ``accepted`` holds (sha): lower-case hex SHA-256 of accepted texts; ``documents`` (id, text) the texts that are still
    there. Only documents whose hash is accepted are history. They are signed and sorted once, unless the ``forest`` holds them already
    (one opened again, for which ``earlier`` has the (id, text) of incoming records marked before); each call of :meth:`mark` then costs
    the signing of its own records, a range search for their labels, and parsing the texts that were located. Its new records
    become a run of the forest for the next call.
    """

    spark: SparkSession
    accepted: DataFrame
    documents: DataFrame
    forest: HashForest
    hot: int = 500
    earlier: DataFrame | None = None

    def __post_init__(self) -> None:
        self.documents = self.documents.filter("id is not null and text is not null")
        if not self.forest.runs:
            signed = self.forest.keep("documents", self.forest.sign(self.documents).withColumn("sha", F.unhex("sha")))
            known = self.accepted.select(F.unhex("sha").alias("sha"))
            first = signed.select("id", "sha").join(known, "sha", "left_semi").groupBy("sha").agg(F.min("id").alias("id")).select("id")
            self.forest.add("documents", signed.join(store(first, "history"), "id", "left_semi"))
        self.texts = {"documents": self.documents}
        if self.earlier is not None:
            self.texts["incoming"] = self.earlier.filter("text is not null").select("id", "text")

    @property
    def fresh(self) -> DataFrame | None:
        """(sha) of the incoming texts that were new."""
        return self.spark.read.schema("sha string").parquet(*self.forest.fresh) if self.forest.fresh else None

    def _sets(self, kind: str, ids: DataFrame) -> DataFrame:
        return gram_sets(only(self.texts[kind], ids.distinct()), self.forest.ngram).dropDuplicates(["id"])

    def _links(self, pairs: DataFrame, kind: str, mine: DataFrame, theirs: DataFrame) -> DataFrame:
        """Of stored pairs (a, b), those that are near-same: by their labels first, then by all n-grams of the whole texts."""
        la, lb = mine.select(F.col("id").alias("a"), F.col("labels").alias("la")), theirs.select(F.col("id").alias("b"), F.col("labels").alias("lb"))
        some = pairs.join(la, "a").join(lb, "b").filter(alike(F.col("la"), F.col("lb")) >= self.forest.floor).select("a", "b")
        some = store(some.distinct(), "alike")
        return verify(some, self._sets("incoming", some.select(F.col("a").alias("id"))), self._sets(kind, some.select(F.col("b").alias("id"))), self.forest.similarity)

    def _confirm(self, located: DataFrame, unit: DataFrame) -> DataFrame:
        """(id) of stored located pairs that are near-same."""
        out = None
        for kind in self.texts:
            theirs = self.forest.labels(kind)
            if theirs is not None:
                some = located.filter(F.col("kind") == kind).select(F.col("id").alias("a"), F.col("other").alias("b"))
                found = self._links(some, kind, unit, theirs).select(F.col("a").alias("id"))
                out = found if out is None else out.unionByName(found)
        return store(out.distinct(), "near")

    def _near(self, unit: DataFrame, records: int, kinds: tuple[str, ...] | None = None) -> DataFrame:
        """(id) of the unit's records that are near-same to an entry of the forest: whole labels first, wider prefixes for records without a partner."""
        near, tried = None, None
        searches = [*self.forest.widths(), None] if self.forest.tails else self.forest.widths()
        for depth in searches:
            rest = unit if near is None else unit.join(near, "id", "left_anti")
            located = self.forest.locate_tails(rest, kinds) if depth is None else self.forest.locate(rest, records, depth, kinds)
            if located is None:
                continue
            if tried is not None:
                located = located.join(tried, ["id", "kind", "other"], "left_anti")
            located = store(located, "located")
            tried = located if tried is None else tried.unionByName(located)
            found = self._confirm(located, unit)
            near = found if near is None else near.unionByName(found)
        return unit.select("id").limit(0) if near is None else near

    def _settle(self, new: DataFrame) -> DataFrame:
        """(id) of the cases within a stored unit of distinct texts, none of which is near-same to the forest; the others join it."""
        mine = entries(new, self.forest.shortest)
        top = mine.groupBy("tree", "stem").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        if top > self.hot:
            # a group of near-copies: an early part leaves few texts of the group in the forest, against which the rest is searched first
            cut_at = new.approxQuantile("id", [0.125], 0.01)[0]
            head, tail = store(new.filter(F.col("id") <= cut_at), "head"), new.filter(F.col("id") > cut_at)
            if not tail.isEmpty():  # ids are distinct, so there is one
                early = self._settle(head)
                near = self._near(tail, tail.count(), ("incoming",))
                return early.unionByName(near).unionByName(self._settle(store(tail.join(near, "id", "left_anti"), "new")))
        lo = mine.select("tree", "stem", F.col("id").alias("lo"), F.col("n").alias("nl"))
        hi = mine.select("tree", "stem", F.col("id").alias("hi"), F.col("n").alias("nh"))
        close = (F.col("lo") < F.col("hi")) & (F.least("nl", "nh") >= F.lit(self.forest.similarity) * F.greatest("nl", "nh"))
        pairs = store(lo.join(hi, ["tree", "stem"]).filter(close).select(F.col("hi").alias("a"), F.col("lo").alias("b")).distinct(), "pairs")
        links = self._links(pairs, "incoming", new, new)
        cases = store(resolve(links.select(F.col("b").alias("lo"), F.col("a").alias("hi"))), "unit-cases")
        self.forest.add("incoming", self.forest.keep("incoming", new.join(cases, "id", "left_anti").select("id", "n", "labels")))
        return cases

    def mark(self, incoming: DataFrame) -> DataFrame:
        """(id, reason) of rows (id, given, text), all of them later than those of the calls before; ids give the order of arrival. ``reason`` is null for
        new records, else ``hash`` (its normalized text's hash or the given one is accepted), ``same`` (the text of an earlier incoming record) or
        ``near`` (near-same to an accepted document or to an earlier incoming record that is new)."""
        texts = incoming.filter("text is not null").select("id", "text")
        self.texts["incoming"] = texts if "incoming" not in self.texts else self.texts["incoming"].unionByName(texts)
        signed = self.forest.sign(incoming.select("id", "text", F.lower(F.trim("given")).alias("given"))).dropDuplicates(["id"])
        known = self.accepted.select(F.col("sha").alias("h")).distinct()
        signed = store(signed, "signed")
        by_hash = signed.select("id", F.explode(F.array("sha", "given")).alias("h")).filter("h is not null").join(known, "h", "left_semi").select("id").distinct().withColumn("by_hash", F.lit(True))
        narrow = signed.select("id", "sha").join(by_hash, "id", "left").withColumn("by_hash", F.coalesce("by_hash", F.lit(False)))
        old = F.lit(False)
        if self.fresh is not None:
            narrow = narrow.join(self.fresh.distinct().withColumn("_old", F.lit(True)), "sha", "left")
            old = F.coalesce("_old", F.lit(False))
        narrow = narrow.withColumn("seen", old).drop("_old")
        # of equal texts the first stands for all: the others repeat it, or what it repeats
        first = narrow.filter("not by_hash and not seen and sha is not null").groupBy("sha").agg(F.min("id").alias("rep"))
        narrow = store(narrow.join(first, "sha", "left"), "batch")
        reps = store(signed.join(narrow.filter("id = rep").select("id"), "id", "left_semi").select("id", "sha", "n", "labels"), "reps")
        near = self._near(reps, reps.count())
        within = self._settle(store(reps.join(near, "id", "left_anti"), "new"))
        near = store(near.unionByName(within).distinct(), "near-all")
        place = f"{self.forest.path}/fresh-{uuid.uuid4().hex}"
        reps.join(near, "id", "left_anti").select("sha").write.parquet(place)
        self.forest.fresh.append(place)
        self.forest.save()
        reason = F.when(F.col("by_hash"), "hash").when(F.col("seen") | (F.col("id") != F.col("rep")), "same").when(F.col("near"), "near")
        return narrow.select("id", "by_hash", "seen", "rep").join(near.withColumn("near", F.lit(True)), "id", "left").select("id", reason.alias("reason"))


def history(documents: DataFrame, commits: DataFrame, *, ngram: int = 3, similarity: float = 0.6, recall: float = 0.9999, path: str = "", earlier: DataFrame | None = None) -> BatchDeduper:
    """What was accepted, ready to mark batches: the hashes of ``commits`` and the documents (doc_id, text) that have them. Hashes are compared without regard to letter case.

    With a ``path`` the forest is kept there. If one is there already it is opened as it is: no document is signed again, and ``earlier`` has
    the (id, text) of the incoming records marked before.
    """
    spark = documents.sparkSession
    accepted = store(commits.select(F.explode("accepted_hashes").alias("sha")).filter("sha is not null").select(F.lower(F.trim("sha")).alias("sha")).distinct(), "accepted")
    docs = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    forest = HashForest.open(spark, path) if path and exists(spark, f"{path}/manifest.json") else HashForest(spark, ngram, similarity, recall, path=path)
    return BatchDeduper(spark, accepted, docs, forest, earlier=earlier)


def mark_incoming(incoming: DataFrame, documents: DataFrame, commits: DataFrame, *, ngram: int = 3, similarity: float = 0.6, recall: float = 0.9999) -> DataFrame:
    """Mark every incoming record as new or as a repetition of something accepted before.

    Returns ``incoming_id, reason``, one row per distinct ``incoming_id``; ``reason`` is null for a new record, else
    ``hash``, ``same`` or ``near`` (see :meth:`BatchDeduper.mark`). Ids rise with the batches and decide what is earlier.

    A null text can only be known by its given hash. Texts with fewer than ``ngram`` words (empty ones too) are only equal
    or not. Null ids are left out, repeated ids count once. Empty tables are no history, or no rows. Other columns are ignored.
    """
    rows = incoming.filter("incoming_id is not null").select(F.col("incoming_id").cast("long").alias("id"), F.col("text_sha256").alias("given"), "text")
    return history(documents, commits, ngram=ngram, similarity=similarity, recall=recall).mark(rows).select(F.col("id").alias("incoming_id"), "reason")
