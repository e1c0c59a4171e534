"""Problem 2: score records for abusive, hateful or sexual content with a counterfactually regularised classifier.

A record's units are the sentences of its text, its title and the words of its address. A unit is a bag of hashed words,
word pairs and shapes after undoing disguises (digits for letters, letters set apart, drawn-out letters; starred words
become shapes). A unit's score is logistic; a record's is that of its worst unit.

Training sees labelled records only, at most ``MOST_LABELLED`` of them (a documented bound: the lowest hashes of the id).
Labels hold for records, so each round takes the units of sound records and the worst unit of toxic ones. Annotators who
disagree are outvoted, ties are left out, and after a round labels that the model contradicts outright are left out.

Counterfactual regularisation: group names (whole words) are swapped for each other and for a neutral word in all labelled
units that hold one, and the squared change of the score is penalised with ``SWAP_PENALTY``, so that a mere mention of a group does not count.
Group names are a parameter; in addition names that stand in labelled toxic units in the plural or after articles are
taken from the data.

Scoring is one pass over Arrow batches; the broadcast model is one vector of ``DIMS`` weights. Rates per source and host
aggregate scores with partial sums; a host that holds a third of all rows is one row per task before the shuffle.

Defined results: null and empty fields have no units, a record without units scores 0; repeated ids are scored each;
without any toxic label every score is 0; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = 1 << 18
MOST_LABELLED = 8_000
SWAP_PENALTY = 0.5
ROUNDS = 3
EPOCHS = 10
THRESHOLD = 0.3
#: Mean log odds of features, less their standard errors, from which the worst unit of a toxic record is believed at first.
FIRST_ODDS = 0.9
LISTED_ODDS = 0.5  # the same for units with a word of the lexicon
POSITIVE_SHARE = 0.08  # weight of all toxic units against that of all sound ones, at least
_SLAB = 2000

#: Words for groups of people, swapped for each other in training; extend by those of a corpus.
IDENTITY_TERMS = (
    "women men girls boys wives husbands jews muslims christians hindus buddhists catholics atheists immigrants migrants refugees foreigners blacks whites asians africans europeans americans arabs turks poles russians "
    "germans frauen männer juden muslime christen ausländer flüchtlinge femmes hommes juifs musulmans chrétiens étrangers migrants mujeres hombres judíos musulmanes cristianos extranjeros inmigrantes donne uomini ebrei "
    "musulmani cristiani stranieri mulheres homens judeus muçulmanos cristãos estrangeiros vrouwen mannen joden moslims christenen buitenlanders женщины мужчины евреи мусульмане христиане gays lesbians"
).split()
NEUTRAL = "neighbours"

#: Words that are abusive, hateful or explicit in most uses, by language; a feature of units whose weight is learned.
LEXICON = {
    "en": "asshole assholes bastard bastards bitch bitches bollocks cocksucker cretin cretins cunt cunts dickhead dumbass fuck fucked fucker fucking fucks moron morons motherfucker nigger paki pathetic retard retarded scum scumbag shit shithead slut sluts subhuman vermin whore whores worthless degenerate parasites filth filthy sewer hentai horny milf milfs naked nsfw nude nudes orgasm porn porno pornography pussy blowjob xxx uncensored busty boobs tits cum hardcore escort strip stripper",
    "de": "abschaum arschloch arschlöcher bastard dreckiges dreckig drecksau fick ficken fickt fotze fresse hure huren hurensohn idioten idiot missgeburt nackte nackt nutte nutten parasiten scheiße scheiß schlampe schlampen spast titten ungeziefer untermenschen verpisst verpiss wichser geile geil porno pornos",
    "fr": "abruti abrutis baise baiser bâtard chienne connard connards connasse cons crever crève débile déchet déchets enculé enculés merde nue nues ordure ordures parasites pédé pétasse pute putes racaille salaud salope salopes sexe vermine porno",
    "es": "asquerosa asqueroso asquerosos basura cabrón cabrones cerda cerdos coño culo desnuda desnudas escoria follando follar gilipollas gilipolla idiotas imbécil imbéciles joder maricón mierda parásitos perra plaga polla puta putas puto sexo zorra zorras porno",
    "it": "bastardi bastardo cagna coglione coglioni cazzo feccia fottere fottuto merda nude nuda parassiti porco puttana puttane scopano scopare schifo schifosi stronza stronzi stronzo troia troie vermi zoccola porno",
    "pt": "bunda caralho cabrão cabrões foder fodam fodendo lixo merda nojenta nojento nojentos nua nuas parasitas porcos porra praga puta putas vadia vadias verme vermes escória porno pornô",
    "nl": "geil geile hoer hoeren hoerenjong kanker klootzak klootzakken kut naakt naakte neuken neukende ongedierte parasieten slet sletten teef tering tyfus uitschot porno smeerlap",
    "ru": "блядь быдло гнида голые дебил дебилы дерьмо идиоты идиот мразь мрази паразиты падаль поганые порно сволочь сволочи сдохли сука суки твари тварь трахаются трахать тупая тупой уроды ублюдки хуй шалава шваль шлюха шлюхи",
}
_LEXICON = {w for v in LEXICON.values() for w in v.split()}

_LEET = str.maketrans("0134578@$€!", "oieastbasei")
_LEETED = re.compile(r"(?=.*[^\W\d_])(?=.*[0134578@$€!])(?!\d+[^\W\d_]{0,3}$)[^\W_]?(?:[^\W\d_]|[0134578@$€!])+(?<!\d\d)$")
_APART = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?![^\W_])")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_SENTENCE = r"([.!?…][.!?…\"”»’)]*)\s+"


def _fnv(text: str) -> int:
    h = 0xCBF29CE484222325
    for b in text.encode("utf-8", "replace"):
        h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


def _bit_of(h):
    """The feature of a hash."""
    return (h ^ (h >> np.uint64(32))) & np.uint64(DIMS - 1) if isinstance(h, np.ndarray) else (h ^ (h >> 32)) & (DIMS - 1)


def plain_word(word: str) -> tuple[str, str]:
    """A word without disguise, and the disguise that was found ('' if none)."""
    low = word.lower()
    shape = ""
    if "*" in low.strip("*") and any(map(str.isalpha, low)):
        core = low.strip("*.,;:!?\"'”“()")
        return f"{core[:1]}*{core[-1:] if core[-1:] != '*' else ''}{len(core)}", "starred"
    core = low.strip(".,;:!?\"'“”„«»()[]…-–—")
    if len(core) <= 24 and _LEETED.match(core) and (word[1:].islower() or word.isupper()):
        core, shape = core.translate(_LEET), "leet"
    drawn = _DRAWN.sub(r"\1", core)
    if drawn != core and "www" not in core:
        core, shape = drawn, "drawn"
    return core, shape


def units_of(url: str | None, title: str | None, text: str | None) -> list[str]:
    """Sentences of the text, the title and the words of the address."""
    out = []
    if text:
        if _APART.search(text):
            text = _APART.sub(lambda m: " apart" + re.sub(r"[ .\-_*]", "", m.group()), text)
        out += re.sub(_SENTENCE, "\\1\x1f", text).split("\x1f")
    if title:
        out.append(_APART.sub(lambda m: " apart" + re.sub(r"[ .\-_*]", "", m.group()), title))
    if url:
        path = re.sub(r"^[a-z]+://[^/]*", "", unquote(url))
        path = re.sub(r"\b(?:index|php|html?|id|p|a|news|blog|articles)\b(?=[\W_])|\d+", " ", path)
        out.append(re.sub(r"[\W_]+", " ", re.sub(r"(?:utm_\w+|ref)=[^&]*", " ", path)))
    return [u for u in out if u.strip()]


class Hasher:
    """Feature ids of units; remembers words."""

    def __init__(self, swap: dict[str, str] | None = None):
        self.known: dict[str, tuple[int, int]] = {}
        self.swap = swap or {}

    def word(self, w: str) -> tuple[int, int]:
        """Hash of the plain word and of its disguise (0 if none)."""
        have = self.known.get(w)
        if have is None:
            plain, shape = plain_word(w)
            if plain.startswith("apart") and len(plain) > 8:
                plain, shape = plain[5:], "apart"
            if plain.isdigit():
                plain = "0"
            feature = "listed " + shape if plain in _LEXICON else "shape " + shape if shape else ""
            have = self.known[w] = (_fnv(self.swap.get(plain, plain)) or 1, _fnv(feature) if feature else 0)
        return have

    def rows(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature ids and the unit of each, for all units together."""
        if len(self.known) > 400_000:
            self.known.clear()
        arr = pa.array(units, pa.string())
        lists = pc.split_pattern_regex(pc.utf8_trim_whitespace(arr), r"\s+")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        code = lists.flatten().dictionary_encode()
        words = [self.word(w) for w in code.dictionary.to_pylist()]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        main = np.array([a for a, _ in words], dtype=np.uint64)
        shape = np.array([b for _, b in words], dtype=np.uint64)
        at = code.indices.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(units)), sizes)
        h, s = main[at], shape[at]
        same = owner[1:] == owner[:-1]
        with np.errstate(over="ignore"):
            pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:])[same]
            pair ^= pair >> np.uint64(29)
        ids = np.concatenate([h, s[s > 0], pair])
        own = np.concatenate([owner, owner[s > 0], owner[1:][same]])
        ids = _bit_of(ids).astype(np.int64)
        key = np.unique(own * np.int64(DIMS) + ids)  # a feature counts once a unit
        return key % DIMS, key // DIMS


class Model:
    """Weights and intercept of the logistic score of a unit."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def logits(self, ids: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        size = np.maximum(1, np.bincount(own, minlength=n))
        return np.bincount(own, self.weights[ids], n) / np.sqrt(size) + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _fit(ids: np.ndarray, own: np.ndarray, y: np.ndarray, weight: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]], start: Model, epochs: int, penalty: float = SWAP_PENALTY) -> Model:
    """Full-batch Adagrad on log loss, ridge and the swap penalty."""
    n = len(y)
    w, b = start.weights.copy(), start.bias
    scale = 1.0 / np.sqrt(np.maximum(1, np.bincount(own, minlength=n)))
    g2, gb2 = np.full(DIMS, 1e-6), 1e-6
    total = weight.sum()
    for _ in range(epochs * 5):
        p = _sigmoid(np.bincount(own, w[ids], n) * scale + b)
        r = (p - y) * weight / total
        grad = np.bincount(ids, (r * scale)[own], DIMS) + 1e-5 * w
        gb = r.sum()
        for ia, oa, ib, ob, m in swaps:
            sa = 1.0 / np.sqrt(np.maximum(1, np.bincount(oa, minlength=m)))
            sb = 1.0 / np.sqrt(np.maximum(1, np.bincount(ob, minlength=m)))
            change = np.bincount(oa, w[ia], m) * sa - np.bincount(ob, w[ib], m) * sb
            k = 2 * penalty * change / (m * len(swaps))
            grad += np.bincount(ia, (k * sa)[oa], DIMS) - np.bincount(ib, (k * sb)[ob], DIMS)
        g2 += grad * grad
        gb2 += gb * gb
        w -= 0.5 * grad / np.sqrt(g2)
        b -= 0.5 * gb / np.sqrt(gb2)
    return Model(w, b)


def discover_groups(units: list[str], toxic: np.ndarray) -> list[str]:
    """Capitalised words inside toxic units that are no place of one unit only and hardly ever stand in lower case."""
    seen, lower, docs = Counter(), Counter(), Counter()
    for u, t in zip(units, toxic):
        words = u.split()
        lower.update({w.strip(".,!?") for w in words if w[:1].islower()})
        if t:
            docs.update({w.strip(".,!?") for k, w in enumerate(words) if w[:1].isupper() and w[1:].islower() and (k or len(words) < 8)})
        seen.update({w.strip(".,!?") for w in words})
    return [w.lower() for w, n in docs.items() if n >= 3 and len(w) > 3 and lower[w.lower()] <= 1 and n >= 0.25 * seen[w]]


def mentioning(units: list[str], groups: list[str]) -> list[bool]:
    """Which units hold the name of a group as a whole word."""
    names = set(groups)
    return [not names.isdisjoint(re.findall(r"[^\W\d_]+", u.lower())) for u in units]


def train(rows: list[tuple[str | None, str | None, str | None, int]], terms: tuple[str, ...] = tuple(IDENTITY_TERMS), rounds: int = ROUNDS, epochs: int = EPOCHS, penalty: float = SWAP_PENALTY) -> Model:
    """Fit on labelled records ``(url, title, text, toxic)``."""
    empty = Model(np.zeros(DIMS), -30.0)
    if not any(r[3] for r in rows) or all(r[3] for r in rows):
        return empty
    units, doc = [], []
    for k, (u, t, c, _) in enumerate(rows):
        own_units = units_of(u, t, c)
        units += own_units
        doc += [k] * len(own_units)
    doc_of, label = np.array(doc), np.array([r[3] for r in rows])
    ids, own = Hasher().rows(units)
    n = len(units)
    # start: log odds of features over records
    pos, neg = np.zeros(DIMS), np.zeros(DIMS)
    key = np.unique(doc_of[own] * np.int64(DIMS) + ids)
    np.add.at(pos, (key % DIMS)[label[key // DIMS] == 1], 1)
    np.add.at(neg, (key % DIMS)[label[key // DIMS] == 0], 1)
    odds = np.log((pos + 0.3) / (label.sum() + 1)) - np.log((neg + 0.3) / ((1 - label).sum() + 1))
    odds[pos + neg < 2] = 0
    model = Model(odds, -2.0)
    groups = sorted({*terms, *discover_groups(units, label[doc_of] == 1)})
    mentions = mentioning(units, groups)
    keep = np.ones(len(rows), dtype=bool)
    # less one standard error, so that a few chance labels say little
    safe = np.where(odds > 0, np.maximum(0, odds - np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))), odds)
    mean_odds = np.bincount(own, safe[ids], n) / np.maximum(1, np.bincount(own, minlength=n))
    marks = [_bit_of(_fnv("listed " + shape)) for shape in ("", "leet", "drawn", "apart")]
    listed = np.bincount(own[np.isin(ids, marks)], minlength=n) > 0
    told = listed & (mean_odds > LISTED_ODDS) & (label[doc_of] == 1)
    for turn in range(rounds):
        # at first by the mean log odds of a unit's features: related ones must not add up
        z = model.logits(ids, own, n) if turn else mean_odds
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, doc_of, z)
        worst = z >= best[doc_of] - 1e-12
        # toxic units are those that the model so far finds likely; the other units of toxic records stay out
        sure = worst & (z > (FIRST_ODDS if turn == 0 else 0.0)) | ((z > 1.0) & (turn > 0))
        use = told | keep[doc_of] & np.where(label[doc_of] == 1, sure, True)
        if not (use & (label[doc_of] == 1)).any():
            use = keep[doc_of] & np.where(label[doc_of] == 1, worst, True)
        at = np.flatnonzero(use)
        new = np.full(n, -1)
        new[at] = np.arange(len(at))
        hit = new[own] >= 0
        y = label[doc_of[at]].astype(np.float64)
        weight = np.where(y == 1, max(1.0, POSITIVE_SHARE * (y == 0).sum() / max(1, y.sum())), 1.0)
        swaps = []
        named = [k for k in at.tolist() if mentions[k]]
        if named:
            texts = [units[k] for k in named]
            a_ids, a_own = Hasher().rows(texts)
            for shift in (1, 7):
                other = {g: groups[(k + shift) % len(groups)] for k, g in enumerate(groups)}
                swaps.append((a_ids, a_own, *Hasher(other).rows(texts), len(texts)))
            swaps.append((a_ids, a_own, *Hasher(dict.fromkeys(groups, NEUTRAL)).rows(texts), len(texts)))
        model = _fit(ids[hit], new[own[hit]], y, weight, swaps, Model(np.zeros(DIMS), -1.0), epochs, penalty)
        z = model.logits(ids, own, n)
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, doc_of, z)
        p = _sigmoid(best)
        if turn < rounds - 1:  # labels that the model contradicts outright are taken for slips
            keep = ~(((label == 0) & (p > 0.8)) | ((label == 1) & (p < 0.2)))
    return model


def score_batch(urls: list, titles: list, texts: list, model: Model, hasher: Hasher) -> np.ndarray:
    units: list[str] = []
    doc: list[int] = []
    for k, (u, t, c) in enumerate(zip(urls, titles, texts)):
        own_units = units_of(u, t, c)
        units += own_units
        doc += [k] * len(own_units)
    out = np.full(len(urls), -np.inf)
    if units:
        ids, own = hasher.rows(units)
        np.maximum.at(out, np.array(doc), model.logits(ids, own, len(units)))
    return np.where(out > -29.9, _sigmoid(out), 0.0)


def labelled(records: DataFrame, labels: DataFrame, id_col: str, bound: int = MOST_LABELLED) -> list[tuple]:
    """Records with the majority label of their annotators; at most ``bound`` (those of the lowest id hashes)."""
    vote = labels.where("toxic is not null").groupBy(id_col).agg(F.avg("toxic").alias("share")).where("share <> 0.5")
    vote = vote.withColumn("h", F.xxhash64(id_col)).orderBy("h", id_col).limit(bound)  # the documented bound of training rows
    got = records.join(vote, id_col).select("u", "t", "c", F.when(F.col("share") > 0.5, 1).otherwise(0).alias("y"), "h", id_col)
    return [(r.u, r.t, r.c, r.y) for r in sorted(got.collect(), key=lambda r: (r.h, r[id_col]))]


def score(records: DataFrame, model: Model, id_col: str = "rec_id") -> DataFrame:
    """``(id, src, host, score)`` of every record."""
    at = np.flatnonzero(model.weights)
    shared = records.sparkSession.sparkContext.broadcast((at.astype(np.int32), model.weights[at].astype(np.float32), model.bias))
    host = F.lower(F.regexp_extract(F.col("u"), r"^[A-Za-z]+://(?:[^/@]*@)?([^/:?#]+)", 1))
    src = records.select(F.col(id_col).cast("bigint").alias(id_col), F.col("src").cast("string").alias("src"), host.alias("host"), F.col("u").cast("string").alias("u"), F.col("t").cast("string").alias("t"), F.col("c").cast("string").alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, values, bias = shared.value
        weights = np.zeros(DIMS)
        weights[where] = values
        m, hasher = Model(weights, bias), Hasher()
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                p = score_batch(s.column(3).to_pylist(), s.column(4).to_pylist(), s.column(5).to_pylist(), m, hasher)
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), s.column(2), pa.array(p)], names=[id_col, "src", "host", "score"])

    return src.mapInArrow(run, f"{id_col} bigint, src string, host string, score double")


def rates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Records, toxic records and their rate per source (``host`` null) and per host (``src`` null)."""
    toxic = F.sum(F.when(F.col("score") >= threshold, 1).otherwise(0))
    grouped = scores.select("src", "host", "score").groupingSets([["src"], ["host"]], "src", "host").agg(F.grouping_id().alias("set"), F.count("*").alias("records"), toxic.alias("toxic"))
    return grouped.withColumn("rate", F.round(F.col("toxic") / F.col("records"), 6)).withColumn("level", F.when(F.col("set") == 1, "src").otherwise("host")).drop("set")
