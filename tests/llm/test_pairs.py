"""Overlap across splits, leaks and batch deduplication against brute force."""

import hashlib
import inspect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import normalize
from corpusloom.llm import kernels as K
from corpusloom.llm.forest import BatchDeduper, HashForest, history, mark_incoming, resolve
from corpusloom.llm.leaks import leaked_passages, word_spans
from corpusloom.llm import dense as D
from corpusloom.llm.overlap import cross_split_overlap, expand, overlap_counts

VOCAB = [f"w{i}" for i in range(400)]


def sha(text):
    return hashlib.sha256(normalize(text).encode()).hexdigest()


def edit(rng, text, share):
    words = text.split(" ")
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = rng.choice(VOCAB)
    return " ".join(words)


def corpus(rng, n):
    """Texts with copies, near-copies of many degrees, a template with slots, and awkward ones."""
    base = [" ".join(rng.choices(VOCAB, k=rng.randint(30, 120))) for _ in range(n)]
    out = list(base)
    for t in rng.sample(base, n // 2):
        out += [edit(rng, t, s) for s in (0.0, 0.02, 0.05, 0.1, 0.15)]
    out += [t.upper() for t in base[:3]] + [t + "\r\n" for t in base[3:6]]
    out += ["", " ", "two words", "Two Words", "two words", "字", "a b c", "a b c"]
    out += [" ".join(["same frame of words that all of these share"] * 3) + f" slot {i}" for i in range(8)]
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_overlap_is_brute_force(spark, hot):
    rng = random.Random(5)
    texts = corpus(rng, 60)
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000, None)]
    splits = {i: rng.choice(["train", "train", "validation", "holdout"]) for i, _ in rows}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, split string")
    records = spark.createDataFrame([(i, s, "src", "y") for i, s in splits.items() for _ in range(2)], "doc_id long, split string, source_id string, text string")
    sets = {i: K.shingles(t, 3) for i, t in rows if t is not None}
    plain = {i: normalize(t) for i, t in rows if t is not None}
    for least in (0.6, 0.0):
        links, members = cross_split_overlap(docs, records, similarity=least, hot=hot)
        got = expand(links, members)
        pairs = {(r.eval_id, r.train_id): r for r in got.collect()}
        want = {}
        for a in sets:
            for b in sets:
                if splits[a] != "train" and splits[b] == "train":
                    both, j = K.jaccard(sets[a], sets[b])
                    if plain[a] == plain[b] or (len(sets[a]) and both / len(sets[a]) >= 0.6 and j >= least):
                        want[a, b] = (both / len(sets[a]) if len(sets[a]) else 1.0, 1.0 if plain[a] == plain[b] else j)
        assert pairs.keys() == want.keys() and len(want) > 30
        for k, (c, j) in want.items():
            assert pairs[k].similarity == pytest.approx(j) and pairs[k].containment == pytest.approx(c)
            assert pairs[k].eval_split == splits[k[0]]
        counts = {(r["split"], r.source): r for r in overlap_counts(links, members, records).collect()}
        for s in ("validation", "holdout"):
            mine = [k for k in want if splits[k[0]] == s]
            assert (counts[s, "src"].pairs, counts[s, "src"].eval_documents, counts[s, "src"].train_documents) == (len(mine), len({a for a, _ in mine}), len({b for _, b in mine}))
    for some, others in ((docs.limit(0), records), (docs, records.limit(0))):
        links, members = cross_split_overlap(some, others)
        assert links.count() == 0 and overlap_counts(links, members, records).count() == 0


@pytest.mark.parametrize("least", [0.6, 0.0])
def test_blocks_of_evaluation_texts_are_brute_force(spark, least):
    """Evaluation texts that go in many blocks, some of one size split by id, with frames that all share and lengths from three words on."""
    rng = random.Random(31)
    frame = " ".join(rng.choices(VOCAB, k=60))
    texts = corpus(rng, 30) + [f"{frame} {' '.join(rng.choices(VOCAB, k=rng.choice([12, 30, 45, 60])))}" for _ in range(60)] + [" ".join(VOCAB[i : i + 3]) for i in range(5)]
    texts += [edit(rng, t, s) for t in texts[-60:-5:3] for s in (0.02, 0.08)]
    splits = {i: rng.choice(["train", "train", "holdout"]) for i in range(len(texts))}
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    links, members = cross_split_overlap(docs, spark.createDataFrame(list(splits.items()), "doc_id long, split string"), similarity=least, hits=4, block_keys=300)
    got = {(r.eval_id, r.train_id) for r in expand(links, members).collect()}
    sets, plain = [K.shingles(t, 3) for t in texts], [normalize(t) for t in texts]
    want = set()
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            if splits[a] != "train" and splits[b] == "train":
                both, j = K.jaccard(x, y)
                if plain[a] == plain[b] or (len(x) and both / len(x) >= 0.6 and j >= least):
                    want.add((a, b))
    assert got == want and len(want) > 20


def test_neither_texts_nor_hits_are_shuffled(spark):
    """Too many ids to be broadcast, and a frame in all texts, so that every pair of them has hits: what is shuffled stays below the texts, which are read where they lie."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=24))
    frame = " ".join(word() for _ in range(60))
    texts = [f"{frame} {' '.join(word() for _ in range(90))}" for _ in range(1500)]
    texts += [t[: t.rindex(" ")] for t in texts[:40]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    records = spark.createDataFrame([(i, "holdout" if i % 5 == 0 and i < 1500 else "train") for i in range(len(texts))], "doc_id long, split string")
    docs.count()
    executors = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False)
    written = lambda: sum(executors().apply(i).totalShuffleWrite() for i in range(executors().size()))
    before, limit = written(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links, members = cross_split_overlap(docs, records, similarity=0.6)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        moved = written() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        docs.unpersist()
    assert {(r.eval_id, r.train_id) for r in expand(links, members).collect()} == {(i, 1500 + i) for i in range(0, 40, 5)}
    assert moved < sum(map(len, texts)) / 2


def test_evaluation_text_within_a_long_training_text(spark):
    rng = random.Random(2)
    words = lambda n: " ".join(f"u{rng.randrange(3000)}" for _ in range(n))
    evals = [words(120) for _ in range(30)]
    docs = [(i, t, "holdout") for i, t in enumerate(evals)]
    docs += [(100 + i, f"{words(2000)} {edit(rng, t, 0.03 * (i % 5))} {words(2000)}", "train") for i, t in enumerate(evals)] + [(200 + i, words(300), "train") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string, split string")
    links, members = cross_split_overlap(df.drop("split"), df.select("doc_id", "split"))
    got = {(r.eval_id, r.train_id): r.containment for r in expand(links, members).collect()}
    assert got[0, 100] == 1.0
    sets = {i: K.shingles(t, 3) for i, t, _ in docs}
    want = {(i, j) for i in range(30) for j in sets if j >= 100 and K.jaccard(sets[i], sets[j])[0] >= 0.6 * len(sets[i])}
    assert got.keys() == want and len(want) >= 25
    assert cross_split_overlap(df.drop("split"), df.select("doc_id", "split"), similarity=0.6)[0].count() == 0


def test_documents_on_both_sides(spark):
    text = " ".join(VOCAB[:40])
    docs = spark.createDataFrame([(1, text), (2, text), (3, text), (4, " ".join(VOCAB[50:90]))], "doc_id long, text string")
    records = spark.createDataFrame([(1, "train", "a"), (1, "holdout", "a"), (2, "holdout", "b"), (3, "validation", "a"), (4, "train", "a"), (4, "holdout", "a")], "doc_id long, split string, source_id string")
    links, members = cross_split_overlap(docs, records)
    assert {(r.eval_id, r.train_id) for r in expand(links, members).collect()} == {(2, 1), (3, 1)}
    assert {(r["split"], r.source, r.eval_documents, r.train_documents, r.pairs) for r in overlap_counts(links, members, records).collect()} == {("holdout", "b", 1, 1, 1), ("validation", "a", 1, 1, 1)}


def test_dense_arrays(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    mask = np.zeros(1 << 16, np.uint8)
    D.set_bits(mask, hashes)
    assert D.has_bits(mask, hashes).all() and D.has_bits(mask, rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.01
    counts = np.zeros(1 << 20, np.uint32)
    np.add.at(counts, D.slots(hashes, 20), 1)
    rows = spark.createDataFrame([(i, bytearray(d)) for i, d in D.blocks_of(counts)] * 3, "block int, data binary").repartition(3)
    assert (D.merge(rows, np.uint32, np.add, 1 << 20) == 3 * counts).all()
    assert not D.merge(rows.limit(0), np.uint32, np.add, 1 << 20).any()


def test_leaks_are_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(VOCAB, k=rng.choice([5, 11, 12, 30])))) for i in range(20)] + [(50, None), (51, ""), (52, "ＡＢＣ １ été 中文字符很多的文本在这里啊")]
    docs = []
    for i in range(60):
        words = rng.choices(VOCAB, k=60)
        if i % 2:
            _, p = rng.choice(items[:20])
            p = p.split(" ")
            n = rng.choice([len(p), 11, 12, 13])
            s = rng.randint(0, max(0, len(p) - n))
            words[20:20] = p[s : s + n]
        docs.append((i, rng.choice([" ", " \n", ", "]).join(words).upper() if i % 3 else "_".join(words)))
    docs += [(100, None), (101, ""), (102, "x abc-1 ÉTÉ: 中文 字符 很多的，文本 在这里啊!"), (103, "word " * 20000 + items[3][1])]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    it = spark.createDataFrame([(i, p, "c") for i, p in items + items[:2]], "item_id long, prompt string, text string")
    got = {(r.doc_id, r.item_id): r for r in leaked_passages(d, it).collect()}
    want = {}
    for i, t in docs:
        tw = K.words_of(normalize(t)) if t else []
        for j, p in items:
            pw = K.words_of(normalize(p)) if p else []
            best = [(a, n) for a in range(len(pw) - 11) for n in [next((m for m in range(len(pw) - a, 11, -1) if any(tw[s : s + m] == pw[a : a + m] for s in range(len(tw) - m + 1))), 0)] if n] if len(tw) < 500 or j == 3 else []
            if best:
                want[i, j] = max(n for _, n in best)
    assert got.keys() == want.keys() and (102, 52) in got
    for (i, j), r in got.items():
        text = dict(docs)[i]
        assert r.words == want[i, j]
        assert " ".join(K.words_of(normalize(text[r.start : r.end]))) in " ".join(K.words_of(normalize(dict(items)[j])))
    twice = d.unionByName(d.limit(20))
    one, many = (sorted(map(str, leaked_passages(twice, it, whole_from=5, max_nodes=m).collect())) for m in (4_000_000, 300))
    assert one == many and len(one) > len(got)
    assert leaked_passages(d.limit(0), it).count() == 0 and leaked_passages(d, it.limit(0)).count() == 0


def test_short_passages_and_answers(spark):
    d = spark.createDataFrame([(1, "before " + " ".join(VOCAB[:8]) + " after"), (2, " ".join(VOCAB[:7])), (3, "x Answer, of FIVE words here y"), (4, "answer of five words")], "doc_id long, text string")
    it = spark.createDataFrame([(7, " ".join(VOCAB[:8]), ["answer of five words here", None, "yes"]), (8, None, None)], "item_id long, prompt string, choices array<string>")
    got = leaked_passages(d, it, passage_cols=("prompt", "choices"), whole_from=5).collect()
    assert {(r.doc_id, r.item_id, r.words, r.covered_words) for r in got} == {(1, 7, 8, 8), (3, 7, 5, 5)}
    assert leaked_passages(d, it, passage_cols=("prompt", "choices")).count() == 0


def test_spans_map_back():
    text = "Ｆｏｏ ﬁne é x"
    assert [text[s:e] for s, e in word_spans(text)] == ["Ｆｏｏ", "ﬁne", "é", "x"]


def sequential(incoming, documents, accepted):
    acc = {h.lower() for h in accepted if h}
    history, out = [], set()
    for _, t in documents:
        if t is not None and sha(t) in acc:
            history.append((normalize(t), K.shingles(t, 3)))
    for i, given, t in sorted(set(incoming)):
        if (given and given.strip().lower() in acc) or (t is not None and sha(t) in acc):
            out.add(i)
        elif t is not None:
            g = K.shingles(t, 3)
            if any(n == normalize(t) or K.jaccard(g, h)[1] >= 0.6 for n, h in history):
                out.add(i)
            else:
                history.append((normalize(t), g))
    return out


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(11)
    texts = corpus(rng, 50)
    rng.shuffle(texts)
    cut = len(texts) // 2
    documents = [(i, t) for i, t in enumerate(texts[:cut])] + [(7777, None)]
    accepted = [sha(t).upper() if i % 2 else sha(t) for i, t in documents if t is not None and i % 3] + [None, sha("gone"), sha("gone")]
    incoming = []
    for i, t in enumerate([*texts[cut:], *[edit(rng, t, 0.05) for t in texts[::3]]]):
        given = rng.choice([None, sha(t), sha(t).upper(), "0" * 64, sha("gone")]) if i % 5 == 0 else sha(t)
        incoming.append((i * 3, given, None if i % 17 == 0 else t))
    return documents, accepted, incoming


def tables(spark, batches):
    documents, accepted, incoming = batches
    docs = spark.createDataFrame([(i, t, "x") for i, t in documents], "doc_id long, text string, text_sha256 string")
    half = len(accepted) // 2
    commits = spark.createDataFrame([("u", accepted[:half]), ("v", accepted[half:]), ("w", []), ("x", None)], "unit_id string, accepted_hashes array<string>")
    inc = spark.createDataFrame([(i, 1 + i // 90, g, t, 1) for i, g, t in incoming + incoming[:5]], "incoming_id long, batch_no long, text_sha256 string, text string, doc_id int")
    return docs, commits, inc


def test_marks_are_the_sequential_loop(spark, batches):
    docs, commits, inc = tables(spark, batches)
    got = mark_incoming(inc, docs, commits).collect()
    want = sequential(batches[2], batches[0], batches[1])
    assert len(got) == len(batches[2]) and {r.incoming_id for r in got if r.reason} == want and 20 < len(want) < len(got)


def test_batches_one_by_one_give_the_same(spark, batches):
    docs, commits, inc = tables(spark, batches)
    deduper = history(docs, commits)
    deduper.forest.max_runs = 2
    out = set()
    for number in sorted(r[0] for r in inc.select("batch_no").distinct().collect()):
        part = inc.filter(F.col("batch_no") == number).select(F.col("incoming_id").alias("id"), F.col("text_sha256").alias("given"), "text")
        out |= {r.id for r in deduper.mark(part).collect() if r.reason}
    assert out == sequential(batches[2], batches[0], batches[1])
    assert len(deduper.forest.runs) <= 3


def test_hot_groups_are_searched_in_parts(spark, batches):
    docs, commits, inc = tables(spark, batches)
    accepted = commits.select(F.explode("accepted_hashes").alias("sha")).filter("sha is not null").select(F.lower("sha").alias("sha")).distinct()
    deduper = BatchDeduper(spark, accepted, docs.select(F.col("doc_id").alias("id"), "text"), HashForest(spark), hot=3)
    rows = inc.select(F.col("incoming_id").alias("id"), F.col("text_sha256").alias("given"), "text")
    assert {r.id for r in deduper.mark(rows).collect() if r.reason} == sequential(batches[2], batches[0], batches[1])


def test_hot_buckets_of_history(spark):
    """History with a large group of near-copies, and texts that share buckets with it without being near."""
    rng = random.Random(8)
    base = " ".join(rng.choices(VOCAB, k=80))
    group = [edit(rng, base, 0.06) for _ in range(60)] + [" ".join(rng.choices(VOCAB, k=50)) for _ in range(20)]
    documents = list(enumerate(group))
    incoming = [(i, None, t) for i, t in enumerate([edit(rng, base, s) for s in (0.0, 0.05, 0.1, 0.2, 0.25, 0.3, 0.5)] + [edit(rng, g, 0.03) for g in group[::7]])]
    accepted = [sha(t) for t in group]
    docs = spark.createDataFrame(documents, "id long, text string")
    acc = spark.createDataFrame([(h,) for h in set(accepted)], "sha string")
    deduper = BatchDeduper(spark, acc, docs, HashForest(spark, hot=4, heads=2, sample=1, salts=3))
    assert deduper.forest.tails
    rows = spark.createDataFrame(incoming, "id long, given string, text string")
    assert {r.id for r in deduper.mark(rows).collect() if r.reason} == sequential(incoming, documents, accepted)


def test_empty_history_and_batches(spark, batches):
    docs, commits, inc = tables(spark, batches)
    assert mark_incoming(inc.limit(0), docs, commits).count() == 0
    got = mark_incoming(inc, docs.limit(0), commits.limit(0))
    assert {r.incoming_id for r in got.collect() if r.reason} == sequential(batches[2], [], [])


def test_chains_of_links(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (5, 6), (7, 8), (7, 8)], "lo long, hi long")
    assert {r.id for r in resolve(edges).collect()} == {2, 4, 5, 8}


def test_prefixes_widen_for_records_without_a_partner(spark):
    """The first search takes whole labels; what it misses is found by shorter prefixes, and the recall measured is the one asked for."""
    rng = random.Random(21)
    base = [[f"z{rng.randrange(5000)}" for _ in range(300)] for _ in range(400)]
    far = []
    for t in base:  # 300 words of which a run is exchanged: similarity a little above 0.6
        t = list(t)
        t[100:172] = [f"y{rng.randrange(5000)}" for _ in range(72)]
        far.append(" ".join(t))
    forest = HashForest(spark)
    assert forest.widths() == [5, 3] and forest.widths(0.9) == [5] and forest.reached(5) < 0.97 < 0.9999 <= forest.reached(3)
    old = forest.keep("documents", forest.sign(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(base)], "id long, text string")))
    forest.add("documents", old)
    batch = forest.sign(spark.createDataFrame(list(enumerate(far)), "id long, text string"))
    found = {d: {r.id for r in forest.locate(batch, 400, d).collect() if r.id == r.other} for d in (5, 3)}
    assert found[5] < found[3] and 340 < len(found[5]) < 400 and len(found[3]) == 400
    assert all(K.jaccard(K.shingles(" ".join(b), 3), K.shingles(f, 3))[1] > 0.6 for b, f in zip(base, far))


def test_a_second_session_signs_no_history(spark, batches, tmp_path):
    docs, commits, inc = tables(spark, batches)
    want = sequential(batches[2], batches[0], batches[1])
    middle = sorted(i for i, *_ in batches[2])[len(batches[2]) // 2]
    rows = inc.select(F.col("incoming_id").alias("id"), F.col("text_sha256").alias("given"), "text")
    path = f"file://{tmp_path}/forest"
    out = {r.id for r in history(docs, commits, path=path).mark(rows.filter(F.col("id") <= middle)).collect() if r.reason}
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("corpusloom_run_")]:
        spark.sql(f"DROP TABLE {name}")  # as a new session knows none

    class Unsigned(HashForest):
        def sign(self, texts):
            assert "given" in texts.columns, "history is signed again"
            return super().sign(texts)

    forest = Unsigned.open(spark, path)
    accepted = commits.select(F.explode("accepted_hashes").alias("sha")).filter("sha is not null").select(F.lower("sha").alias("sha")).distinct()
    again = BatchDeduper(spark, accepted, docs.select(F.col("doc_id").alias("id"), "text"), forest, earlier=rows.filter(F.col("id") <= middle))
    assert {r[0] for r in forest.runs} == {"documents", "incoming"}
    out |= {r.id for r in again.mark(rows.filter(F.col("id") > middle)).collect() if r.reason}
    assert out == want


def test_a_pair_at_the_limit_is_missed_once_in_ten_thousand(spark):
    f = HashForest(spark)
    assert f.reached(f.widths()[-1]) >= 0.9999 and inspect.signature(mark_incoming).parameters["recall"].default == 0.9999
