import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tidewrack.llm import boilerplate as B
from tidewrack.llm import langid, quality, spam
from tidewrack.llm.blocks import Blocks, CommonWords

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples():
    t = pd.read_parquet(f"{D}/lang_samples.parquet")
    return sorted(zip(t.lang, t.text))


@pytest.fixture(scope="module")
def common():
    return CommonWords(pd.read_parquet(f"{D}/common_words.parquet").groupby("lang").word.apply(list).to_dict())


@pytest.fixture(scope="module")
def chain(samples, common):
    return B.train(samples, common)


def test_held_out_pages(samples, common, chain):
    pages, pieces, titles = B.compose(samples, 200, seed=99)
    b = Blocks(pa.array(pages), pa.array(titles))
    x, _ = B.features(b, common, pa.array(titles))
    assert (chain.decode(x, b.doc, b.n_docs) == B._labels(b, pages, pieces)).mean() > 0.95


#: Furniture in two languages that no list of the package holds.
SWEDISH = {
    "nav": "Hem|Om oss|Kontakt oss|Produkter|Tjänster|Sök|Nyheter|Evenemang|Hjälp|Butik|Logga in|Arkiv|Varukorg|Platskarta|Villkor|Integritet|Till toppen|Inställningar",
    "notices": ("Vi sparar små filer för att ge dig bästa service.| Godkänn alla | Inställningar", "Den här sidan lagrar uppgifter om dig.| Läs mer"), "prompts": "Dela den här sidan;Annons;Skriv ut sidan;Prenumerera på vårt nyhetsbrev;Kommentarer (7);Hoppa till innehållet",
    "sides": "Liknande artiklar;Mest lästa;Senaste nytt", "footers": "{n} AB, alla rättigheter förbehållna.| Integritet | Villkor;Till toppen – Platskarta – Villkor;Följ oss   Nyhetsbrev   Tillgänglighet",
}
POLISH = {
    "nav": "Strona główna|O nas|Oferta|Usługi|Szukaj|Aktualności|Wydarzenia|Pomoc|Sklep|Zaloguj|Archiwum|Koszyk|Mapa strony|Regulamin|Prywatność|Do góry|Ustawienia",
    "notices": ("Zapisujemy małe pliki, aby poprawić usługi.| Akceptuj wszystko | Ustawienia", "Ta strona zapisuje dane o tobie.| Dowiedz się więcej"), "prompts": "Udostępnij tę stronę;Ogłoszenie;Drukuj stronę;Zapisz się do biuletynu;Komentarze (7);Przejdź do treści",
    "sides": "Podobne artykuły;Najczęściej czytane;Ostatnie wpisy", "footers": "{n}, wszelkie prawa zastrzeżone.| Prywatność | Regulamin;Do góry – Mapa strony – Regulamin;Obserwuj nas   Biuletyn   Dostępność",
}


def held_out(samples, common, chain, words, html):
    """Recall and precision on furniture blocks of pages whose furniture is in another language."""
    pages, pieces, titles = B.compose(samples, 300, 77, {k: dict.fromkeys({lang for lang, _ in samples}, v) for k, v in words.items()})
    whole = [k for k, p in enumerate(pages) if "\n" in p]  # a page of one line is cut into blocks by its words
    pages, pieces, titles = ([x[k] for k in whole] for x in (pages, pieces, titles))
    pages = B.as_html(pages, pieces, 1.0) if html else pages
    b = Blocks(pa.array(pages), pa.array(titles))
    x, _ = B.features(b, common, pa.array(titles))
    y, got = B._labels(b, pages, pieces), chain.decode(x, b.doc, b.n_docs)
    return (got[y == 1] == 1).mean(), (y[got == 1] == 1).mean()


@pytest.mark.parametrize("words", [SWEDISH, POLISH])
def test_furniture_in_languages_of_no_list(samples, common, chain, words):
    plain, boxed = held_out(samples, common, chain, words, False), held_out(samples, common, chain, words, True)
    print(plain, boxed)
    assert plain[0] > 0.45 and plain[1] > 0.9 and boxed[0] > 0.75 and boxed[1] > 0.9
    listed_only = B.train(samples, common, hidden=0.0)
    assert held_out(samples, common, listed_only, words, False)[0] < plain[0] - 0.15  # hiding the lists in training is what finds them


def test_html_bodies(spark, small):
    import re

    from tidewrack.llm.queries import QUERIES

    got = {r.id: r.body for r in QUERIES["p3_html_bodies"](spark, small).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").where("text is not null").collect()}
    assert got.keys() == docs.keys()
    fold = lambda t: re.sub(r"\W+", "", t)
    assert np.mean([any(w in b for w in ("Departments", "Timetables", "Elsewhere", "Boats and people", "Harbour office")) for b in got.values()]) < 0.05
    kept = [fold(docs[i])[:200] in fold(b) for i, b in got.items() if len(docs[i]) > 200 and docs[i].isascii()]
    assert np.mean(kept) > 0.8


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    for n in range(1, 7):
        x, chain = rng.normal(size=(n, 3)), B.Chain(rng.normal(size=3), rng.normal(size=(2, 2)))
        emit = x @ chain.unary
        best = max(itertools.product((0, 1), repeat=n), key=lambda p: sum(emit[k] for k in range(n) if p[k]) + sum(chain.pair[a, b] for a, b in itertools.pairwise(p)))
        assert chain.decode(x, np.zeros(n, int), 1).tolist() == list(best)


def test_gradient_of_the_chain():
    """A chain fitted to clear data labels it right."""
    x = np.array([[1.0, 0], [1, 1], [1, 1], [1, 0]] * 5)
    y = np.array([0, 1, 1, 0] * 5)
    doc = np.repeat(np.arange(5), 4)
    assert (B.fit(x, doc, y, rounds=150).decode(x, doc, 5) == y).all()


PAGE = "Home | About us | Contact\nA day in Hartwick\nThe mill by the river was built in 1820. It still grinds corn.\nRelated articles\nThe old barn of Velby\nA walk to the sea\n© 2021 Hartwick Post. All rights reserved. Privacy policy | Terms of use"


def test_body_of_a_page(spark, common, chain):
    df = spark.createDataFrame([(1, PAGE, "A day in Hartwick"), (2, None, None), (3, "", "t"), (4, PAGE.replace("\n", " "), "A day in Hartwick"), (1, PAGE, "A day in Hartwick")], "rec_id bigint, c string, t string")
    lines = {(r.id, r.line_no) for r in B.furniture_lines(df, "raw_docs", "rec_id", "c", "t", chain, common).collect()}
    assert lines == {(1, 0), (1, 3), (1, 4), (1, 5), (1, 6), (4, 0)}
    body = {r.id: r.body for r in B.main_bodies(df, "raw_docs", "rec_id", "c", "t", chain, common).collect()}
    assert body[1] == "A day in Hartwick\nThe mill by the river was built in 1820. It still grinds corn." and body[2] == body[3] == ""
    assert "grinds corn" in body[4] and "Home" not in body[4] and "rights" not in body[4]


def test_html_pages_by_ancestors():
    b = Blocks(pa.array(["<html><body><nav><a>Home</a></nav><article><p>The mill stands by the river.</p></article><script>x()</script></body></html>"]))
    assert b.text.to_pylist() == ["Home", "The mill stands by the river."] and b.tags == [("nav", "a"), ("article", "p")]


def test_classes_of_characters_are_those_of_patterns():
    import pyarrow.compute as pc

    from tidewrack.llm.blocks import class_counts

    t = pa.array(["", "Aé ß Ж9\t½Ⅷ", "日本語 한 عربي", "🌿 x", "ǅ ÀÁ\r\n٣"])
    got = class_counts(t)
    for name, p in (("letters", r"\p{L}"), ("numbers", r"\p{N}"), ("blanks", r"\s"), ("capitals", r"\p{Lu}")):
        assert got[name].tolist() == pc.count_substring_regex(t, p).to_pylist()


def test_sketches_merge_exactly():
    rng = np.random.default_rng(1)
    x = rng.lognormal(3, 1, 4000)
    whole, parts = quality.Sketch("n_chars"), []
    for part in np.array_split(x, 7):
        b, n = np.unique(quality.to_bin("n_chars", part), return_counts=True)
        parts.append(quality.Sketch("n_chars", dict(zip(b.tolist(), n.tolist()))))
    for p in parts:
        whole = whole.merge(p)
    for q in (0.05, 0.5, 0.95):
        assert abs(whole.quantile(q) / np.quantile(x, q) - 1) < 0.03
    assert whole.n == 4000 and abs(whole.percentile(np.array([np.median(x)]))[0] - 0.5) < 0.02
    assert np.isnan(quality.Sketch("n_chars").quantile(0.5))


def test_prose_and_rows(spark, common, chain):
    prose = "The mill by the river was built in 1820. It still grinds corn for the village, and it is open in summer."
    rows = "\n".join(f"Hartwick 0{k}:15 1{k}:20 1{k}:45" for k in range(8))
    df = spark.createDataFrame([(i, prose) for i in range(60)] + [(100, rows), (101, "let a=f(1);\nif(a){run(a);}\n" * 5), (102, None), (103, ""), (104, rows.replace("\n", " "))], "rec_id bigint, c string")
    stats = quality.statistics(df, "raw_docs", "rec_id", "c", None, chain, common)
    sk = quality.collect_sketches(quality.sketches(stats))
    assert {r.id for r in quality.flag(stats, sk).where("non_prose").collect()} == {100, 101, 104}
    st = quality.standing(stats, sk).where("stat = 'n_words' and id = 5").first()
    assert st.value == 21 and 0 < st.pct < 1
    empty = stats.where("false")
    assert quality.flag(empty, quality.collect_sketches(quality.sketches(empty))).count() == 0


def test_rows_that_are_the_majority_of_a_language(spark, common, chain):
    prose = [f"The mill by the river was built in {1800 + i}. It still grinds corn for the village, and it is open in summer. The {w} is old." for i in range(60) for w in ("house", "barn", "road")]
    table = "\n".join(f"Ankunft und Abfahrt der Züge 0{k}:15 1{k}:20 1{k}:45" for k in range(8))
    other = "\n".join(f"Preis für die Karte mit der Bahn {k}0,50 {k}1,20" for k in range(8))
    german = "Die Mühle am Fluss wurde 1820 gebaut. Sie mahlt noch immer das Korn für das Dorf, und im Sommer ist sie offen."
    rows = [(i, t) for i, t in enumerate(prose)] + [(1000 + i, f"{german} {'Das Haus ist alt. ' * i}") for i in range(20)]
    df = spark.createDataFrame(rows + [(2000 + i, table) for i in range(100)] + [(3000, other)], "rec_id bigint, c string")
    stats = quality.statistics(df, "raw_docs", "rec_id", "c", None, chain, common).cache()
    assert stats.where("id >= 2000 and lang = 'de'").count() == 101
    names = ("sentence_share",)
    assert {r.n for r in quality.sketches(quality.distinct_texts(stats.where("id between 2000 and 2999"), names), names).where("lang = 'de'").collect()} == {7}
    for seen in (quality.distinct_texts(stats), stats):  # even without bounded copies, all languages are the better reference
        got = {r.id for r in quality.flag(stats, quality.collect_sketches(quality.sketches(seen))).where("non_prose").collect()}
        assert got == {*range(2000, 2100), 3000}


def test_tails_of_the_corpus_decide(spark, common, chain):
    """The same page is in the tails of one corpus and in the middle of another."""
    page = "\n".join(f"{w} and the {v} of the village" for w in ("Mills", "Barns", "Roads") for v in ("river", "house", "wood"))
    prose = [f"The mill by the river was built in {1800 + i}. It still grinds corn for the village, and it is open in summer. The house is {'very ' * (i % 5)}old." for i in range(80)]
    lists = ["\n".join(f"{rng_w} and the {v} of the village" for rng_w in ("Fields", "Ponds", "Walls")[: 1 + i % 3] for v in ("church", "school", "inn", "road")[: 2 + i % 3]) + f"\n{'It is the old part of the village, and it is open in summer. ' * (i % 2)}" for i in range(80)]
    verdicts = []
    for corpus in (prose, lists):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)] + [(1000, page)], "rec_id bigint, c string")
        stats = quality.statistics(df, "raw_docs", "rec_id", "c", None, chain, common).cache()
        got = quality.flag(stats, quality.collect_sketches(quality.sketches(quality.distinct_texts(stats)))).where("id = 1000").first()
        assert got.junk_share > 0.5  # the exact check alone says the same of both
        verdicts.append(got.non_prose)
    assert verdicts == [True, False]


def test_few_documents_of_a_language_are_drawn_towards_all():
    rng = np.random.default_rng(3)
    make = lambda x: quality.Sketch("mean_word", dict(zip(*(v.tolist() for v in np.unique(quality.to_bin("mean_word", x), return_counts=True)))))
    whole, last = make(rng.normal(5, 0.5, 5000)), None
    for n in (0, 1, 49, 50, 51, 500, 50_000):  # no switch at any number
        own = make(rng.normal(8, 0.5, n)) if n else quality.Sketch("mean_word")
        mid, _ = quality.Reference({("*", "mean_word"): whole, ("de", "mean_word"): own}, "de", "mean_word").spread()
        assert last is None or mid >= last - 0.1
        last = mid
    assert last > 7.9 and abs(quality.Reference({("*", "mean_word"): whole}, "de", "mean_word").spread()[0] - 5) < 0.1


def test_spam(spark, common):
    prose = ["The mill by the river was built in 1820. It grinds corn, and the bakery beside it sells rye bread on most days.", "A night train leaves the old station at ten. Few people take it, for the road is quicker now and costs less.", "My aunt keeps bees behind the barn. She gave us three jars of honey when we left the farm in autumn."]
    good = [(i, " ".join(prose[k % 3] for k in range(i % 3, i % 3 + 3)), []) for i in range(120)]
    stuffed = "cheap paint | best paint | paint online | buy paint | paint near me | paint shop | paint sale | cheap paint online | best paint shop | paint | buy cheap paint | paint offers"
    said = "Buy the paint here, because this paint is a cheap paint and a good paint. " * 5
    parts = "\n".join(f"* {k} kg apples\n- {k + 3} boxes red plums" for k in range(12))
    links = " ".join(f"https://h{k}.example.org/cheap-paint-{k}" for k in range(6))
    df = spark.createDataFrame(good + [(200, stuffed, ["x"]), (201, said, None), (202, parts, []), (203, links, []), (204, None, None), (205, "  ", [])], "crawl_id bigint, text string, links array<string>")
    pages = spam.measured(df, "crawl_id", "text", None, "links", common)
    got = {r.id: r.why for r in spam.judge(pages).where("spam").collect()}
    assert got == {200: "no sentences", 201: "keyword sentences", 203: "addresses"}
    assert spam.judge(pages.where("false")).count() == 0


def spam_page(rng, kind):
    """A page of invented keywords, towns and hosts: its text, title and number of links."""
    word = lambda n: "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(n))
    key = [f"{word(2)} {word(3)}" for _ in range(rng.choice([1, 1, 3]))]
    towns = [word(3).title() for _ in range(40)]
    add = ["cheap", "best", "online", "sale", "near me", "reviews", "2026"]
    k = lambda: rng.choice(key)
    n = rng.randint(10, 40)
    if kind == 0:
        return "\n".join(f"{k()} {rng.choice(towns)}{rng.choice(['', ' - ' + rng.choice(add), f' ({rng.randint(2, 90)})'])}" for _ in range(n)), key[0], n
    if kind == 1:
        return rng.choice([" | ", "; ", ", "]).join(f"{rng.choice(add)} {k()}" for _ in range(n)), f"{key[0]} online", 3
    if kind == 2:
        return "\n".join(f"https://{word(3)}-{word(2)}.example.org/{key[0].replace(' ', '-')}-{rng.randint(1, 9999)}" for _ in range(max(6, n // 3))), "Links", n
    if kind == 3:
        return " ".join(f"#{rng.choice(add).replace(' ', '')}{k().replace(' ', '')}" for _ in range(n)), key[0], 0
    return " ".join(rng.choice([f"Buy {key[0]} here because {key[0]} is what you need.", f"Our {key[0]} is the best {key[0]} in {rng.choice(towns)}.", f"Looking for {key[0]} online? This is the {key[0]} page."]) for _ in range(n // 3 + 3)), f"All about {key[0]}", 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_recall_on_own_variants_of_spam(spark, common, samples, seed):
    import random
    import re

    rng = random.Random(seed)
    sentences = {}
    for lang, t in samples:
        sentences.setdefault(lang, []).extend(s for s in re.split(r"(?<=[.!?…])\s+", t) if len(s) > 20)
    good = []
    for i in range(700):
        own = sentences[rng.choice(sorted(sentences))]
        good.append((i, " ".join(rng.sample(own, min(len(own), rng.randint(3, 16)))), "A day out", 2))
    # more spam of one language and length than natural pages
    bad = [(10_000 + i, *spam_page(rng, i % 5)) for i in range(500)]
    df = spark.createDataFrame([(i, t, title, ["x"] * n) for i, t, title, n in good + bad], "crawl_id bigint, text string, t string, links array<string>")
    got = {r.id for r in spam.judge(spam.measured(df, "crawl_id", "text", "t", "links", common).cache()).where("spam").collect()}
    found = sum(i >= 10_000 for i in got)
    assert found >= 0.95 * len(bad) and len(got) - found <= 0.01 * len(good)


def test_all_characters_are_in_a_block():
    whole = "the mill by the river " * 30
    for tail in (1, 79, 80, 81):
        text = whole[: spam.BLOCK] + "abcdefghij" * 9
        ratio, size = spam.block_ratio(text[: spam.BLOCK + tail])
        assert size == spam.BLOCK + tail and 0 < ratio < 1
    redundant, other = spam.block_ratio("a" * 660)[0], spam.block_ratio("a" * 600 + "".join(chr(97 + (k * 7 + k // 13) % 26) for k in range(60)))[0]
    assert other > redundant  # the tail tells


def test_garbled_pages_are_read_whatever_the_number_of_marks(common):
    for n in (1, 2, 3, 4):
        text = " ".join(["Die schöne Brücke führt über den Fluss."] * n)
        for codec in ("cp1252", "latin-1"):
            assert Blocks(pa.array([text.encode().decode(codec)])).text.to_pylist() == Blocks(pa.array([text])).text.to_pylist()
    assert Blocks(pa.array(["Où va la rivière ? À Köln, £5 – Дождь «СССР»."])).text.to_pylist() == ["Où va la rivière ?", "À Köln, £5 – Дождь «СССР»."]


def test_spam_that_holds_a_third_of_all_rows(spark, common):
    things = ["mill", "barn", "station", "orchard", "library", "bakery", "harbour", "garden", "tower", "bridge"]
    said = ["was built by the river long ago", "is open to all guests in summer", "needs a new roof before winter", "stands behind the old school", "lost two windows in the storm", "belongs to a family of bakers"]
    good = [(i, " ".join(f"The {things[(i + 3 * k) % 10]} {said[(i // 10 + k) % 6]}." for k in range(6)), []) for i in range(60)]
    stuffed = "cheap paint | best paint | paint online | buy paint | paint near me | paint shop | paint sale | cheap paint online | best paint shop | paint | buy cheap paint | paint offers"
    for third in ([stuffed] * 60, [f"{stuffed} {k}" for k in range(60)]):  # the same page, and one that varies in numbers
        df = spark.createDataFrame(good + [(100 + k, t, []) for k, t in enumerate(third)] + [(500, stuffed.replace("paint", "glass"), [])], "crawl_id bigint, text string, links array<string>")
        got = {r.id for r in spam.judge(spam.measured(df, "crawl_id", "text", None, "links", common)).where("spam").collect()}
        assert got == {*range(100, 160), 500}


def test_languages(spark, samples, common, chain):
    m = langid.train(samples[::2])
    held = [s for s in samples[1::2]]
    got = langid.passages(pa.array([t for _, t in held]), None, m, chain, common)
    assert np.mean([g["lang"] == lang for g, (lang, _) in zip(got, held)]) > 0.97
    en, de, ru = (next(t for lang, t in held if lang == x) for x in ("en", "de", "ru"))
    rows = [(1, en, "EN-gb "), (2, de, "de"), (3, en + " " + de, "en"), (4, ru, None), (5, ru, "utf-8"), (6, None, "en"), (7, "", "en"), (8, "1 2 3 | 4 5 6", "en"), (9, de, "fr")]
    df = spark.createDataFrame(rows, "rec_id bigint, c string, l string")
    found = langid.identify(df, "rec_id", "c", None, "l", m, chain, common)
    assert {(r.id, r.lang) for r in langid.mislabelled(found).collect()} == {(3, "en"), (3, "de"), (4, "ru"), (5, "ru"), (9, "de")}
    mixed = found.where("id = 3").first()
    assert [p.lang for p in mixed.passages] == ["en", "de"] and all(0 < p.confidence <= 1 for p in mixed.passages)
    assert langid.identify(df.where("false"), "rec_id", "c", None, "l", m, chain, common).count() == 0


def test_models_are_fitted_once(spark):
    from tidewrack.llm import models

    times = []
    fit = lambda: times.append(1) or {"a": np.arange(3), "b": np.array(["x", "y"])}
    key = models.digest([("en", "text"), len(times), id(times)], quality)
    first = models.fitted(spark, "test", key, fit)
    models._KEPT.clear()  # as in a later run
    again = models.fitted(spark, "test", key, fit)
    assert times == [1] and again["a"].tolist() == [0, 1, 2] and again["b"].tolist() == first["b"].tolist()
    assert models.digest([("en", "text")], quality) != models.digest([("en", "other")], quality) != models.digest([("en", "other")], langid)


def test_languages_of_no_sample_are_rejected(samples, common, chain):
    m = langid.train(samples)
    foreign = ["Ez egy rövid mondat magyarul a hídról.", "Tämä on lyhyt lause suomeksi talosta.", "To jest krótkie zdanie po polsku o moście.", "Bu köprü hakkında kısa bir cümledir."]
    got = langid.passages(pa.array(foreign), None, m, chain, common)
    assert [g["lang"] for g in got] == ["und"] * 4 and not any(g["languages"] for g in got)
    known = langid.passages(pa.array([t for _, t in samples]), None, m, chain, common)
    assert all(g["lang"] != "und" for g in known)
