"""Token budgets, text quality and splitting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import budget, quality, splitting
from corpusloom.llm import kernels as K

SF = "/root/testdata/sf0.01"


def test_estimates_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    est, q = budget.estimate_tokens(docs, per_language=300)
    true = {r.doc_id: K.count_tokens(r.text) for r in docs.filter("text is not null").collect()}
    got = {r.id: r for r in est.collect()}
    assert got.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    assert abs(sum(got[i].est_tokens for i in true) / sum(true.values()) - 1) < 0.03
    assert np.median([abs(got[i].est_tokens / max(1, true[i]) - 1) for i in true]) < 0.1
    assert all(r.error < 0.3 for r in q.collect())


def test_estimates_of_awkward_rows(spark):
    rows = [(1, None, None), (2, "", "EN"), (3, "x", "und"), (4, "y" * 300_000, "en-XA"), (4, "y" * 300_000, "en_xb"), (5, "中文", " ZH "), (6, "été", "x-unknown")]
    df = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, lang string, source string, tokens int")
    est, _ = budget.estimate_tokens(df, keep=("source",))
    got = sorted(map(tuple, est.select("id", "lang", "bytes", "est_tokens", "source").collect()))
    assert len(got) == 7 and [g[1] for g in got] == ["und", "en", "und", "en", "en", "zh", "und"]
    assert got[0][3] == got[1][3] == 0.0 and all(1 <= g[3] <= g[2] for g in got[2:])
    empty, q = budget.estimate_tokens(df.limit(0))
    assert empty.count() == 0 and q.count() == 1


def test_counts_are_the_plain_ones():
    text = "Ab c1, 中文 é\n\t=�"
    got = dict(zip(budget.FEATURES, budget.text_counts(text)))
    assert got == {"bytes": len(text.encode()), "words": 5, "lower": 2, "upper": 1, "letter": 1, "han": 2, "digit": 1, "space": 4, "newline": 1, "stop": 1, "symbol": 1, "odd": 1}
    assert budget.text_counts("")[0] == 0


def test_quota_check(spark):
    est = spark.createDataFrame([(1, "aa", 100.0), (2, "aa", 100.0), (3, "bb", 50.0), (4, None, 0.0)], "id long, sha string, est_tokens double")
    commits = spark.createDataFrame([("b", "s", "x", ["AA", "bb", None, "aa"]), ("b", "s", "x", ["cc"]), ("b", "s", "y", []), ("b", None, "x", ["aa"])], "build_id string, stage string, source_id string, accepted_hashes array<string>")
    progress = spark.createDataFrame(
        [("b", "s", "x", 1, 10, None, 1), ("b", "s", "x", 2, 500, None, 1), ("b", "s", "x", 2, 160, "complete", 2), ("b", "s", "y", 5, 7, None, 1), ("b", None, "x", 1, 90, None, 1)],
        "build_id string, stage string, source_id string, row_cursor long, accepted_quota_tokens long, status string, reported_at long",
    )
    got = {(r.stage, r.source_id): (r.accepted_quota_tokens, r.accepted_texts, r.est_tokens) for r in budget.quota_check(est, commits, progress).collect()}
    assert got == {("s", "x"): (160, 2, 150.0), ("s", "y"): (7, 0, 0.0), (None, "x"): (90, 1, 100.0)}


PROSE = "The council of the old town decided that the bridge would be repaired before the winter, and most of the people who lived near it were glad. Nobody knew why it had been closed for so long, although there were many rumours about the river."
LISTS = {
    "table": "\n".join(f"{n:<14}{v:>6}{v * 1.7:9.2f}  {w}  ZX" for n, v, w in zip("Karin Torelo Masok Pelda Norim Alver".split() * 4, range(100, 9000, 300), "rack beam node cell clock relay".split() * 4)),
    "code": "\n".join(f"def f{i}(a, b=None):\n    if b is None or a.x > {i}:\n        return g_{i}(a, {i})\n    return b[{i}] += a * 3" for i in range(8)),
    "json": "\n".join('{"alarm": %d, "name": "Corofa", "seq": %d}' % (i, i * 31) for i in range(20)),
    "log": "\n".join(f"05:25:{i:02d}.357 WARN miwen[{i * 7}] codec={i * 301} rc=0x1b{i:02d}" for i in range(20)),
    "settings": "\n".join(f"buffer_size{i} = {i}\n[section{i}]\nuse_cache=true" for i in range(12)),
    "index": "\n".join(f"{i}.{i % 7} Splitter overview ............ {i * 3}" for i in range(3, 30)),
    "terms": "\n".join(f"* {w}, {v}" for w, v in zip("engine wall rare beacon furnace".split() * 5, "kelfa bridge idle soil horn".split() * 5)),
    "menu": "\n".join("Home » Search » Login » Privacy | Contact | Sitemap" for _ in range(8)),
    "repeated": PROSE * 12,
    "advert": "Click Tanxigro enzyme Corhajaslum 14636 " * 20,
    "garbled": "sa}[_ni_f§Â]>g] k½~^ *i<je_Âyv>k>âo*�ât■#¿ic œ_#Âwq{n¿âz¿¿fy§n]*k™z hp\\¼d&rija>½žw}=^rh$cx" * 4,
    "base64": "uhL55Dd0HHxLY1u5lKBWM/Jro+MLvD3NSHAiIEMsQ76/9oLk4Z+9u2UT3JabOuil6kLq458JB4JO\n" * 1 + "mo3t7EEWkWyVLT2o5TcKYgvv/EkdgOifVGkpSwi/gGm9XnNGCeEOQ1i4J466RAYPO94xCL60T6dJ\n",
}
PROSES = {
    "plain": PROSE,
    "no marks": PROSE.replace(",", "").replace(".", "").lower(),
    "capitals": PROSE.upper(),
    "title": PROSE.title(),
    "wrapped": "\n".join(PROSE[i : i + 60] for i in range(0, len(PROSE), 60)),
    "numbered": "\n".join(f"[{i:04d}] {s}" for i, s in enumerate(PROSE.split(", "))),
    "quoted": "\n".join("> " + PROSE[i : i + 70] for i in range(0, len(PROSE), 70)),
    "german": "Wenn die Sprache schwach ist, muss die Antwort nach 23 Sekunden verworfen werden. Nur 50 von allen Proben waren sicher, und keine Insel wurde verworfen. Die Fähigkeit wird von ihm schnell bestätigt und danach an die Messung weitergegeben.",
    "chinese": "当气候超过一定的时候，小区开始影响试验。这个终端不仅更新了农民，而且改变了安静的小区。因此，局部的系统和学校都应该被发送。如果病人没有比较音乐，那么局部的市场需要等待贸易。",
    "with a block": PROSE + "\n\n```\nget_x(7)\nset_y(8)\n```\n\n" + PROSE,
}


@pytest.mark.parametrize("kind", LISTS)
def test_structures_are_not_prose(kind):
    assert quality.describe(LISTS[kind])["structure"] != "prose"


@pytest.mark.parametrize("kind", PROSES)
def test_prose_in_many_forms(kind):
    d = quality.describe(PROSES[kind])
    assert d["structure"] == "prose"
    if kind in ("german", "chinese"):
        assert d["language"] == {"german": "de", "chinese": "zh"}[kind]


def test_quality_table(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, PROSE), (4, PROSE), (5, "x" * 200_000), (6, PROSE * 500)]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, words int")
    got = {r.doc_id: r for r in quality.text_quality(df).collect()}
    assert set(got) == {2, 3, 4, 5, 6} and quality.text_quality(df).count() == 6
    assert got[2].structure == "empty" and got[2].words == 0 and got[4].structure == "prose" and got[6].structure == "repeated"
    assert got[4].mean_word_length == pytest.approx(np.mean([len(w) for w in K.words_of(PROSE)])) and got[4].ended_lines == 1.0
    assert quality.text_quality(df.limit(0)).count() == 0


def test_divergence_is_bounded():
    a, b = np.eye(7), np.full((1, 7), 1 / 7)
    d = quality.divergence(a, quality._smooth(a))
    assert np.allclose(np.diag(d), 0) and (d <= 1).all() and (d[~np.eye(7, dtype=bool)] > 0.9).all()
    assert np.allclose(quality.divergence(b, quality._smooth(b)), 0)


def check_pieces(text, limit=1500, overlap=100):
    pieces = splitting.split_text(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    ids = K.tokenizer().encode_ordinary(text)
    ends = np.cumsum(K.token_bytes()[np.array(ids)]) if ids else np.array([])
    for (s, e, n), (s2, _, _) in zip(pieces, pieces[1:]):
        assert s < s2 < e
        tokens_in_overlap = ((ends > len(text[:s2].encode())) & (ends <= len(text[:e].encode()))).sum()
        assert overlap - 1 <= tokens_in_overlap <= overlap + 4
    for s, e, n in pieces:
        assert n == K.count_tokens(text[s:e]) <= limit
    return pieces


def test_splitting_keeps_all_text():
    rng = random.Random(2)
    sentences = [" ".join(rng.choices(PROSE.split(), k=rng.randint(4, 20))) + "." for _ in range(900)]
    text = "".join(s + rng.choice([" ", " ", "\n", "\n\n"]) for s in sentences)
    for s, e, _ in check_pieces(text)[:-1]:
        assert text[e - 1] in " \n" and text[:e].rstrip()[-1] == "."
    check_pieces("\n".join(f"line {i} value {i * 7}" for i in range(3000)))
    check_pieces("中文没有空格" * 900)
    check_pieces("word " * 5000)
    check_pieces("x" * 9000)
    check_pieces("😀" * 2000)
    assert splitting.split_text("short") == [(0, 5, 1)]
    with pytest.raises(ValueError):
        splitting.split_text(text, 100, 60)


def test_cuts_lie_in_valleys():
    a = "The river and the bridge near the mill were flooded by the river. "
    b = "A compiler turns source code into machine code for the compiler. "
    text = a * 60 + b * 60
    (s, e, _), *_ = splitting.split_text(text, 1500)
    assert abs(e - len(a) * 60) <= 2 * len(a)


def test_split_table(spark):
    rows = [(1, None), (2, ""), (3, "tiny"), (4, PROSE * 60), (5, PROSE * 900)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, pieces string")
    got = splitting.split_documents(df).collect()
    assert {r.doc_id for r in got} == {2, 3, 4, 5}
    long = sorted((r for r in got if r.doc_id == 5), key=lambda r: r.piece)
    assert [r.piece for r in long] == list(range(long[0].pieces)) and max(r.tokens for r in long) <= 1500
    joined = long[0].text
    for a, b in zip(long, long[1:]):
        joined += b.text[a.end - b.start :]
    assert joined == PROSE * 900
    assert splitting.split_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("lang, text", [
    ("sv", "Solen gick upp över den lilla staden när barnen vaknade. De sprang ut på gatan och lekte tills modern ropade att det var dags för frukost. Det hade regnat hela natten, men nu var himlen klar."),
    ("pl", "Rano poszliśmy nad rzekę, ponieważ pogoda była bardzo ładna. Moja siostra powiedziała, że nie chce się kąpać, więc została na brzegu i czytała książkę. Po południu wróciliśmy do domu."),
    ("ru", "Утром мы пошли к реке, потому что погода была очень хорошая. Моя сестра сказала, что не хочет купаться, и осталась на берегу с книгой. Вечером мы вернулись домой, где нас уже ждал ужин."),
    ("ko", "아침에 우리는 날씨가 아주 좋아서 강으로 갔다. 내 동생은 수영하고 싶지 않다고 말하고 강가에 남아 책을 읽었다. 저녁에 우리는 집으로 돌아왔고 어머니가 저녁을 준비하고 있었다."),
    ("ja", "朝、天気がとてもよかったので、私たちは川へ行きました。妹は泳ぎたくないと言って、岸に残って本を読んでいました。夕方になって家に帰ると、母が夕食を作って待っていました。"),
])
def test_prose_in_further_languages(lang, text):
    got = quality.describe(text)
    assert got["structure"] == "prose" and got["language"] == lang and got["common_words"] > 0.2


def test_common_words_are_those_of_the_language():
    text = "The valve will die when the pressure rises. It is opened by the engine and closed by a spring."
    assert quality.describe(text)["common_words"] < quality.describe(text.replace("die", "not"))["common_words"]
