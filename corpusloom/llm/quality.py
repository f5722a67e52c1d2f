"""Per-document text statistics, and natural prose told from lists, tables, code and junk by divergence from structural profiles."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import nfkc
from corpusloom.llm import kernels as K

#: Function words by language; a window is read in the language with most of them. Korean words are told by their last syllable, Japanese ones by hiragana.
FUNCTION_WORDS = {
    "en": "the a an of in on at to for from by with as and or but not no nor is are was were be been being am has have had do does did will would shall should can could may might must that this these those which who whom whose what when where why how if then than so because while although though after before since until unless whether it its he his him she her they their them we our us you your i my me there here all any each every some such most more only also into over under about between through during against within without upon yet still both either neither just up out off",
    "de": "der die das den dem des ein eine einer eines einem einen und oder aber nicht kein keine ist sind war waren wird werden wurde wurden hat haben hatte von vom zu zum zur mit bei nach aus auf für über unter zwischen durch gegen ohne um als wie wenn weil dass ob auch nur noch schon man wir sie er es ich ihr in im am an so dann bis vor seit jede jeder jedes diese dieser dieses sich hier alle muss soll kann",
    "fr": "le la les l un une des du de d et ou mais ne pas est sont était a ont avait être avoir ce cette ces cet qui que quoi dont où dans sur sous avec sans pour par en au aux il elle ils elles on nous vous je se s son sa ses leur leurs plus moins très si quand lorsque comme car donc aussi même tout tous toute chaque n y fut avant après selon soit",
    "es": "el la los las lo un una unos unas de del al y o pero no es son era fue ha han había ser estar esta este esto estas estos ese esa que quien cual cuyo donde en con sin por para sobre entre hasta desde se su sus más menos muy si cuando como porque también tan ya cada todo toda todos según sea aunque",
    "it": "il lo la i gli le un uno una di del della dei delle da in nel nella con su per tra fra e o ma non è sono era erano ha hanno che chi cui come quando dove se anche più si suo sua questo questa ogni tutti al alla",
    "pt": "o a os as um uma de do da dos das em no na nos nas por para com sem sobre entre e ou mas não é são era foi tem que quem como quando onde se seu sua mais também cada todo toda este esta ao à pelo pela",
    "nl": "de het een van in op te en of maar niet geen is zijn was waren wordt werd heeft had met voor door aan bij uit naar over onder tussen om als dat die dit deze er ook nog al wel zo dan wij zij hij ze ik",
    "sv": "och att det som en ett den på är av för med till inte om har de var vid från eller men när så kan ska efter under över mellan också denna detta dessa sin sitt hon han vi ni sig hade skulle genom utan alla mycket där här",
    "da": "og at det som en et den på er af for med til ikke om har de var ved fra eller men når så kan skal efter under over mellem også denne dette disse sin sit hun han vi sig havde ville gennem uden alle meget hvor her blev være",
    "pl": "się nie na do to że jest jak ale po co tak za od przez dla jego jej już tylko był była było być może przy bez oraz lub który która które także ich ten ta te tym tego przed nad pod gdy są został została więc czy",
    "cs": "se je na to že ale do by si jsem jako pro po od které který která tak však také nebo před při už být byl byla bylo jsou jeho její jen ještě než když podle mezi pod nad ve ze ke aby co",
    "fi": "ja on ei että se oli hän mutta myös kun niin kuin tai sekä ovat ole joka jotka tämä sen hänen jos vain vielä sitten mukaan kanssa ennen jälkeen olla olivat",
    "tr": "ve bir bu da de için ile olarak olan çok daha ancak gibi kadar sonra olduğu ne o en her ise ya değil var yok onun bunu şu ki mi",
    "ru": "и в не на что с по а как это к из у за от о для но же то все так его она он они мы вы бы был была были было быть или при до если только уже еще когда где чтобы этот эта эти который которая которые также после перед без под над во со их ее",
    "uk": "і в не на що з та як це до у за від про для але же то все так його вона він вони ми ви був була були було бути або при якщо тільки вже ще коли де щоб цей ця ці який яка які також після перед без під над їх її й",
    "el": "και το η ο να του της την τα των στο στη με για από που δεν είναι θα τον οι ένα μια ως αλλά ή σε στην στον κατά μετά αυτό αυτή",
    "ko": "은 는 이 가 을 를 에 의 로 과 와 도 다 고 며 서 면 지 나 게 만 한 된 할 던 들 요 까 니",
    "ja": "の は を に が で と も へ や から まで より です ます した する して いる ある",
    "zh": "的 了 在 是 不 和 都 就 也 而 且 如 果 那 么 我 们 因 此 当 候 之 后 可 以 这 个 应 该 被 比 更 对 从 到 把 与 或 为 有 没 其 他 她 它 你 您 会 能 要 所 很 但 又 还 上 中 下 着 过 得 地 等",
}
LANGUAGES = tuple(FUNCTION_WORDS)
_MASKS: dict[str, int] = {}
for _bit, _lang in enumerate(LANGUAGES):
    for _word in FUNCTION_WORDS[_lang].split():
        _MASKS[_word] = _MASKS.get(_word, 0) | 1 << _bit

_KOREAN_ENDS = frozenset(FUNCTION_WORDS["ko"].split())

#: Kinds of tokens; a distribution over them is what profiles are compared by.
KINDS = ("function", "plain", "capital", "number", "stop", "symbol", "line")
#: Share of each kind in typical text of a structure, in the order of KINDS, set by hand from samples of such texts. Prose comes in several forms: with and without
# marks, hard-wrapped, in Chinese, where every character is a word, numbered with many marks, and with every word capitalized.
PROFILES = {
    "prose": ((0.42, 0.40, 0.06, 0.01, 0.10, 0.00, 0.01), (0.45, 0.48, 0.04, 0.02, 0.00, 0.00, 0.01), (0.38, 0.38, 0.07, 0.02, 0.08, 0.00, 0.07), (0.30, 0.60, 0.00, 0.01, 0.08, 0.00, 0.01), (0.30, 0.42, 0.12, 0.03, 0.11, 0.01, 0.01), (0.34, 0.33, 0.07, 0.05, 0.16, 0.03, 0.02), (0.42, 0.03, 0.43, 0.01, 0.10, 0.00, 0.01), (0.45, 0.02, 0.48, 0.02, 0.00, 0.00, 0.03)),
    "list": ((0.01, 0.62, 0.08, 0.06, 0.03, 0.00, 0.20), (0.02, 0.45, 0.18, 0.06, 0.06, 0.06, 0.17), (0.01, 0.15, 0.50, 0.04, 0.10, 0.02, 0.18)),
    "index": ((0.01, 0.20, 0.15, 0.16, 0.40, 0.00, 0.08), (0.01, 0.08, 0.10, 0.16, 0.58, 0.00, 0.07)),
    "table": ((0.00, 0.16, 0.26, 0.32, 0.15, 0.01, 0.10), (0.00, 0.14, 0.18, 0.15, 0.08, 0.38, 0.07), (0.01, 0.20, 0.20, 0.30, 0.22, 0.00, 0.07)),
    "log": ((0.01, 0.20, 0.09, 0.30, 0.28, 0.09, 0.03), (0.02, 0.22, 0.06, 0.35, 0.16, 0.15, 0.04)),
    "data": ((0.00, 0.22, 0.08, 0.14, 0.46, 0.08, 0.02), (0.00, 0.25, 0.05, 0.10, 0.20, 0.36, 0.04)),
    "settings": ((0.00, 0.46, 0.01, 0.06, 0.00, 0.33, 0.14), (0.00, 0.40, 0.02, 0.10, 0.12, 0.22, 0.14)),
    "code": ((0.14, 0.34, 0.03, 0.06, 0.20, 0.15, 0.08), (0.08, 0.30, 0.08, 0.06, 0.24, 0.16, 0.08), (0.10, 0.38, 0.05, 0.08, 0.16, 0.18, 0.05), (0.14, 0.04, 0.35, 0.06, 0.20, 0.14, 0.07)),
    "menu": ((0.04, 0.10, 0.52, 0.01, 0.02, 0.22, 0.09), (0.03, 0.14, 0.68, 0.01, 0.02, 0.01, 0.11)),
    "keywords": ((0.01, 0.94, 0.02, 0.01, 0.01, 0.00, 0.01), (0.02, 0.66, 0.05, 0.02, 0.24, 0.00, 0.01), (0.01, 0.40, 0.40, 0.18, 0.00, 0.00, 0.01), (0.01, 0.40, 0.55, 0.02, 0.01, 0.00, 0.01)),
    "garbled": ((0.02, 0.28, 0.02, 0.05, 0.05, 0.58, 0.00), (0.02, 0.45, 0.05, 0.06, 0.05, 0.37, 0.00), (0.01, 0.02, 0.02, 0.60, 0.02, 0.23, 0.10), (0.01, 0.30, 0.05, 0.40, 0.05, 0.15, 0.04)),
}
STRUCTURES = tuple(PROFILES)
_NAMES = np.array([STRUCTURES.index(s) for s in STRUCTURES for _ in PROFILES[s]])


def _smooth(p: np.ndarray) -> np.ndarray:
    p = p + 0.003
    return p / p.sum(axis=-1, keepdims=True)


_PROFILES = _smooth(np.array([p for s in STRUCTURES for p in PROFILES[s]]))
_TOKEN = re.compile(f"[^\\W_{K.HAN}]+|[{K.HAN}]|\\n|[^\\w\\s*]|_")  # asterisks mark emphasis and bullets, and say nothing of either
_FUNC, _PLAIN, _CAPITAL, _NUMBER, _STOP, _SYMBOL, _LINE, _CAPS = range(8)
_MARKS = set(K.PROSE_MARKS)


class _TokenKinds(dict):
    """Kind of a token in the lowest 3 bits, above them the languages of which it is a function word; a cache of fixed size."""

    BOUND = 1 << 20

    def __missing__(self, token: str) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        kind = self[token] = self.kind(token)
        return kind

    @staticmethod
    def kind(token: str) -> int:
        if token == "\n":
            return _LINE
        if token in _MARKS:
            return _STOP
        if not token[0].isalnum():
            return _SYMBOL
        mask = _MASKS.get(token.lower(), 0) << 3
        if token[0] >= "\u3041":  # kana and Hangul stand in runs that aren't single words
            if all("\u3041" <= c <= "\u309f" for c in token):
                mask |= 8 << LANGUAGES.index("ja")
            elif "\uac00" <= token[-1] <= "\ud7a3" and token[-1] in _KOREAN_ENDS and len(token) > 1:
                mask |= 8 << LANGUAGES.index("ko")
        if len(token) > 28 or any(c.isdigit() for c in token):
            return _NUMBER
        if len(token) > 1 and token.isupper():
            return _CAPS | mask
        return (_CAPITAL if token[0].isupper() else _PLAIN) | mask


_KINDS = _TokenKinds()


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of every row of ``p`` from every row of ``q``."""
    p, q = _smooth(p)[:, None, :], q[None, :, :]
    m = np.log2((p + q) / 2)
    return ((p * (np.log2(p) - m)).sum(-1) + (q * (np.log2(q) - m)).sum(-1)) / 2


def _windows(kinds: np.ndarray, least: int = 40, block: int = 8, most: int = 120) -> list[int]:
    """Where windows begin: whole lines are put together up to ``least`` tokens, or to the next blank line if they have at least ``block``; a
    line of more than ``most`` is cut by that many."""
    starts, begin, last, end = [], 0, -2, len(kinds)
    for stop in [*(np.flatnonzero(kinds == _LINE) + 1).tolist(), end]:
        while stop - begin > most:
            starts.append(begin)
            begin += most if stop - begin >= most + least else (stop - begin) // 2
        if stop - begin >= (block if stop == last + 1 else least) or stop == end and begin < end:
            starts.append(begin)
            begin = stop
        last = stop
    return starts


def profile(text: str) -> tuple[dict[str, float], str]:
    """Share of the characters of a text in windows nearest to each structure, and the language of most function words.

    A text is looked at in windows of whole lines or parts of long ones. A window's function words are those of the one
    language with most of them; capitals are read as lower case in a window that is mostly in capitals.
    """
    tokens = _TOKEN.findall(text)
    if not tokens:
        return {}, ""
    packed = np.fromiter(map(_KINDS.__getitem__, tokens), np.int32, len(tokens))
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    kinds, masks = packed & 7, packed >> 3
    starts = np.array(_windows(kinds))
    bits = np.add.reduceat((masks[:, None] >> np.arange(len(LANGUAGES))) & 1, starts, axis=0)
    best = bits.argmax(axis=1)
    window = np.repeat(np.arange(len(starts)), np.diff([*starts, len(tokens)]))
    function = (masks >> best[window]) & 1 == 1
    counts = np.zeros((len(starts), 8), np.int64)
    np.add.at(counts, (window, np.where(function, _FUNC, kinds)), 1)
    words = counts[:, [_FUNC, _PLAIN, _CAPITAL, _NUMBER, _CAPS]].sum(axis=1)
    capitals = np.bincount(window, (kinds == _CAPS) | (kinds == _NUMBER), len(starts)) > 0.7 * np.maximum(words, 1)
    counts[:, _PLAIN] += np.where(capitals, counts[:, _CAPS], 0)
    counts[:, _CAPITAL] += np.where(capitals, 0, counts[:, _CAPS])
    shape = counts[:, :7].astype(float)
    shape /= np.maximum(shape.sum(axis=1, keepdims=True), 1)
    nearest = _NAMES[divergence(shape, _PROFILES).argmin(axis=1)]
    weights = np.add.reduceat(sizes, starts)
    share = np.bincount(nearest, weights, len(STRUCTURES)) / max(1, weights.sum())
    total = bits.sum(axis=0)
    return {s: float(v) for s, v in zip(STRUCTURES, share)}, LANGUAGES[int(total.argmax())] if total.any() else ""


def distinct_share(words: list[str], n: int = 3) -> float:
    """Distinct runs of ``n`` words, as a share of all; 1 where there are none."""
    m = len(words) - n + 1
    return len(K.ngram_hashes(words, n)) / m if m > 0 else 1.0


def describe(text: str, repeated_below: float = 0.34) -> dict:
    """All figures of a text; see :func:`text_quality`."""
    plain = nfkc(text)
    words = K.words_of(plain)
    kinds = np.bincount(K.classes_of(text), minlength=len(K.CLASSES)) if text else np.zeros(len(K.CLASSES), int)
    by = dict(zip(K.CLASSES, kinds.tolist()))
    visible = max(1, len(text) - by["space"] - by["newline"])
    lines = [x for x in (line.rstrip() for line in text.splitlines()) if x]
    share, lang = profile(plain)
    distinct = distinct_share(words)
    prose = share.get("prose", 0.0)
    if prose > 0.5 and distinct < repeated_below and len(words) >= 30:
        structure = "repeated"
    elif prose > 0.5:
        structure = "prose"
    else:
        other = {s: v for s, v in share.items() if s != "prose"}
        structure = max(other, key=other.get) if other and max(other.values()) > 0 else "empty" if not share else "prose"
    bit = 1 << LANGUAGES.index(lang) if lang else 0
    return {
        "chars": len(text),
        "words": len(words),
        "mean_word_length": sum(map(len, words)) / len(words) if words else 0.0,
        "symbol_ratio": (by["symbol"] + by["odd"]) / visible,
        "digit_ratio": by["digit"] / visible,
        "lines": len(lines),
        "ended_lines": sum(x[-1] in ".!?:;\"')»”’。！？" for x in lines) / len(lines) if lines else 0.0,
        "common_words": sum(_KINDS[w] >> 3 & bit > 0 for w in words) / len(words) if words else 0.0,
        "distinct_trigrams": distinct,
        "prose_share": prose,
        "language": lang,
        "structure": structure,
    }


_FIELDS = {"chars": "long", "words": "long", "mean_word_length": "double", "symbol_ratio": "double", "digit_ratio": "double", "lines": "long", "ended_lines": "double", "common_words": "double", "distinct_trigrams": "double", "prose_share": "double", "language": "string", "structure": "string"}


def text_quality(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures of every document that tell natural prose from other structures.

    A text is cut into windows of lines. The distribution of a window over function words, other words, capitals, numbers,
    prose marks, symbols and line ends is compared with profiles of prose (in several typographic forms) and of other
    structures by Jensen-Shannon divergence, the function words being those of the language with most of them; the nearest
    profile is the window's structure. A document is ``prose`` if more than half of its characters are in prose windows and its
    runs of three words aren't mostly repetitions (``repeated``); else it has the structure of most of the rest.

    Returns ``doc_id, chars, words, mean_word_length, symbol_ratio, digit_ratio, lines, ended_lines`` (share of non-empty lines that end in
    punctuation), ``common_words`` (share of words that are function words of the text's language), ``distinct_trigrams, prose_share, language, structure``.

    Null texts give no row; an empty text is ``empty`` with zeros. Whole texts are read. Repeated rows give repeated rows; an empty
    table gives none. Other columns are ignored. One pass, no shuffle.
    """
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is not None:
                    ids.append(i)
                    rows.append(describe(text))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array([r[f] for r in rows], kinds[k]) for f, k in _FIELDS.items()]], ["doc_id", *_FIELDS])

    return documents.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"{f} {k}" for f, k in _FIELDS.items()))
