"""Problem 7: language of documents and passages by nearest centroid over normalised TF-IDF character n-grams.

Each language has ``CENTROIDS`` spherical k-means centroids of its clean samples (``lang_samples``, a table that does not
grow). A block's vector is its hashed character trigrams weighted by inverse document frequency; its score for a
language is the largest cosine to the language's centroids. A block is rejected (language ``und``) if its distance to
the nearest centroid is larger than samples of that language have, by ``SLACK``.

A document's passages are runs of sentences of one language; sentences differ from the language of the whole document
only by a margin of ``MARGIN``. The confidence is the best cosine's share of the sum of the two best languages.

All of it is one pass over Arrow batches, without a shuffle; the broadcast model has ``DIMS`` x languages x centroids
numbers. Defined results: null, empty and wordless texts have no passage; documents below the rejection bound have
``und``; repeated rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import inspect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, CommonWords
from .boilerplate import Chain, tag

DIMS = 1 << 15
CENTROIDS = 3
SLACK = 0.3  # of the least cosine seen in samples
MARGIN = 0.04
LEAST_LETTERS = 12
_SLAB = 2000

#: Codes that name a language (ISO 639-1, the two-letter codes; fixed values).
ISO_639_1 = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz "
    "ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt "
    "qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()


def gram_ids(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all strings and the string each belongs to."""
    plain = pc.replace_substring_regex(pc.utf8_lower(text), r"[^\p{L}\p{M}]+", " ")
    plain = pc.binary_join_element_wise(pa.scalar(" "), pc.utf8_trim_whitespace(plain), pa.scalar(" "), "")
    sizes = pc.utf8_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(plain.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(text)), sizes)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    with np.errstate(over="ignore"):
        three = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (c * np.uint32(0xC2B2AE3D))
        three ^= three >> np.uint32(15)
    same = owner[2:] == owner[:-2]
    return (three & np.uint32(DIMS - 1))[same].astype(np.int64), owner[2:][same]


class Centroids:
    """``weights`` (DIMS, languages * CENTROIDS) hold idf times the unit centroids; ``idf`` the weights of grams."""

    def __init__(self, languages: list[str], weights: np.ndarray, idf: np.ndarray, least: np.ndarray):
        self.languages, self.weights, self.idf, self.least = languages, weights, idf, least

    def cosines(self, text: pa.Array) -> np.ndarray:
        """Best cosine of each string to each language."""
        grams, owner = gram_ids(text)
        n, k = len(text), self.weights.shape[1]
        out = np.zeros((n, k), dtype=np.float32)
        if not len(grams):
            return out.reshape(n, len(self.languages), -1).max(axis=2)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rows = owner[starts]
        step = 400_000
        for lo in range(0, len(starts), 4096):
            hi = min(len(starts), lo + 4096)
            a = starts[lo]
            z = starts[hi] if hi < len(starts) else len(grams)
            part = np.zeros((hi - lo, k), dtype=np.float32)
            for s in range(a, z, step):  # bounded memory for very long strings
                e = min(z, s + step)
                cuts = starts[lo:hi]
                first = int(np.searchsorted(cuts, s, side="right")) - 1
                last = int(np.searchsorted(cuts, e, side="left"))
                at = np.maximum(cuts[first:last], s) - s
                part[first:last] += np.add.reduceat(self.weights[grams[s:e]], at, axis=0)
            out[rows[lo:hi]] = part
        norm = np.sqrt(np.bincount(owner, self.idf[grams] ** 2, minlength=n))
        out /= np.maximum(norm, 1e-9)[:, None]
        return out.reshape(n, len(self.languages), -1).max(axis=2)


def train(samples: list[tuple[str, str]], seed: int = 5) -> Centroids:
    """Centroids of labelled clean texts, cut into sentences."""
    import re

    texts: list[str] = []
    labels: list[str] = []
    for lang, text in sorted((a, b) for a, b in samples if a and b):
        for s in re.split(r"(?<=[.!?…])\s+", text):
            if len(s) >= 20:
                texts.append(s)
                labels.append(lang)
    languages = sorted(set(labels))
    arr = pa.array(texts, pa.string())
    grams, owner = gram_ids(arr)
    cells, times = np.unique(owner * np.int64(DIMS) + grams, return_counts=True)  # sparse: sentence, gram and its number
    at, gram = cells // DIMS, cells % DIMS
    df = np.bincount(gram, minlength=DIMS)
    # grams that several languages share weigh less: the document frequency counts languages evenly
    idf = np.log((1 + len(texts)) / (1 + df)).astype(np.float32)
    idf[df == 0] = np.log(1.0 + len(texts))
    value = (times * idf[gram]).astype(np.float32)
    value /= np.maximum(np.sqrt(np.bincount(at, value**2, len(texts))), 1e-9)[at]
    rng = np.random.default_rng(seed)
    centers = np.zeros((len(languages) * CENTROIDS, DIMS), dtype=np.float32)
    y = np.array(labels)
    for k, lang in enumerate(languages):
        rows = np.flatnonzero(y == lang)
        mine = np.isin(at, rows)
        own = np.zeros((len(rows), DIMS), dtype=np.float32)  # the sentences of one language at a time
        own[np.searchsorted(rows, at[mine]), gram[mine]] = value[mine]
        c = own[rng.choice(len(own), size=CENTROIDS, replace=len(own) < CENTROIDS)]
        for _ in range(12):
            nearest = (own @ c.T).argmax(axis=1)
            c = np.stack([own[nearest == j].mean(axis=0) if (nearest == j).any() else c[j] for j in range(CENTROIDS)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        centers[k * CENTROIDS : (k + 1) * CENTROIDS] = c
    model = Centroids(languages, np.ascontiguousarray((centers * idf).T), idf, np.zeros(len(languages)))
    cos = model.cosines(arr)
    model.least = np.array([np.quantile(cos[y == lang, k], 0.01) for k, lang in enumerate(languages)]) * SLACK
    return model


def passages(pages: pa.Array, titles: pa.Array | None, model: Centroids, chain: Chain, common: CommonWords, texts: bool = True) -> list[dict]:
    """Per page: ``lang`` and ``confidence`` of the whole, complete-sentence languages, passages, and the non-prose share."""
    b, state, s = tag(pages, titles, chain, common)
    n, count = b.n_docs, len(model.languages)
    body = (state == 0) & (s["letters"] >= LEAST_LETTERS)
    at = np.flatnonzero(body)
    cos = np.zeros((len(b), count), dtype=np.float32)
    if len(at):
        cos[at] = model.cosines(b.text.take(pa.array(at)))
    weight = np.where(body, s["letters"], 0).astype(np.float64)
    whole = np.stack([b.sum_by_doc(cos[:, k] * weight) for k in range(count)], axis=1) / np.maximum(1e-9, b.sum_by_doc(weight))[:, None]
    main = whole.argmax(axis=1)
    best = cos.argmax(axis=1)
    rows = np.arange(len(b))
    lead = cos[rows, best] - cos[rows, main[b.doc]] if len(b) else np.zeros(0)
    lang = np.where(lead >= MARGIN, best, main[b.doc]) if len(b) else best
    known = body & (cos[rows, lang] >= model.least[lang]) if len(b) else body
    complete = known & s["sentence"] & s["ended"] & (s["letters"] >= 2 * LEAST_LETTERS)
    junk = b.sum_by_doc(np.where((state == 0) & ~s["sentence"], s["chars"], 0)) / np.maximum(1, b.sum_by_doc(np.where(state == 0, s["chars"], 0)))
    order = np.sort(whole, axis=1)[:, ::-1]
    runner = order[:, 1] if count > 1 else np.zeros(n)
    share = order[:, 0] / np.maximum(1e-9, order[:, 0] + runner)
    out = [{"lang": model.languages[main[d]] if whole[d, main[d]] >= model.least[main[d]] else "und", "confidence": float(share[d]), "languages": [], "passages": [], "junk": float(junk[d])} for d in range(n)]
    text = b.text.to_pylist() if texts else []
    for k in np.flatnonzero(known if texts else complete).tolist():
        doc, code = out[b.doc[k]], model.languages[lang[k]]
        if complete[k] and code not in doc["languages"]:
            doc["languages"].append(code)
        if not texts:
            continue
        pair = np.sort(cos[k])[::-1][:2]
        sure = float(cos[k, lang[k]] / max(1e-9, cos[k, lang[k]] + (pair[1] if count > 1 and lang[k] == best[k] else pair[0])))
        if doc["passages"] and doc["passages"][-1]["lang"] == code:
            p = doc["passages"][-1]
            size = len(p["text"])
            p["confidence"] = (p["confidence"] * size + sure * len(text[k])) / (size + len(text[k]))
            p["text"] += " " + text[k]
        else:
            doc["passages"].append({"lang": code, "confidence": sure, "text": text[k]})
    return out


def label_code(label):
    """The two-letter code a label names, by the part before region or script; null if it names no language."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2})(?:[-_][A-Za-z0-9]+)*$", 1))
    return F.when(code.isin(*ISO_639_1), code)


SCHEMA = "id bigint, label string, lang string, confidence double, languages array<string>, junk double, passages array<struct<lang:string,confidence:double,text:string>>"


def identify(df: DataFrame, id_col: str, text_col: str, title_col: str | None, label_col: str, model: Centroids, chain: Chain, common: CommonWords, texts: bool = True) -> DataFrame:
    """Language, confidence, languages of complete sentences, and (unless not ``texts``) passages of every document."""
    shared = df.sparkSession.sparkContext.broadcast((model, chain, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, c, words = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("text", pa.string())]))
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                got = passages(s.column(2), s.column(3), m, c, words, texts)
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), s.column(1), pa.array([g["lang"] for g in got], pa.string()), pa.array([g["confidence"] for g in got]), pa.array([g["languages"] for g in got], pa.list_(pa.string())), pa.array([g["junk"] for g in got]), pa.array([g["passages"] for g in got], kind)],
                    names=["id", "label", "lang", "confidence", "languages", "junk", "passages"],
                )

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"), (F.col(title_col) if title_col else F.lit(None)).cast("string").alias("title")).where("text is not null and text <> ''")
    return src.mapInArrow(run, SCHEMA)


def mislabelled(found: DataFrame) -> DataFrame:
    """``(id, lang)`` of prose whose label is missing, no language or another one, or that mixes languages."""
    langs = F.when(F.size("languages") > 0, F.col("languages")).otherwise(F.array("lang"))
    code = label_code(F.col("label"))
    wrong = code.isNull() | ~F.array_contains(langs, code) | (F.size(langs) > 1)
    return found.where(F.col("junk") <= 0.5).where(wrong).select("id", F.explode(langs).alias("lang")).where("lang <> 'und'")


def load(samples: DataFrame) -> Centroids:
    """The model of a table of clean samples (lang, text) of bounded size; fitted once and kept."""
    from . import models

    rows = [(r.lang, r.text) for r in samples.select("lang", "text").orderBy("lang", "text").collect()]

    def fresh() -> models.Arrays:
        m = train(rows)
        return {"languages": np.array(m.languages), "weights": m.weights, "idf": m.idf, "least": m.least}

    got = models.fitted(samples.sparkSession, "languages", models.digest(rows, inspect.getmodule(load)), fresh)
    return Centroids(got["languages"].tolist(), got["weights"], got["idf"], got["least"])
