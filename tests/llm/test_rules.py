import random

import numpy as np
import pytest

from tidewrack.llm import pii, residue, toxicity

FOUND = [
    ("Dear {{ user.first_name }}, welcome.", "placeholder"), ("Hello ${NAME}", "placeholder"), ("<%= page.title %>", "placeholder"), ("[AUTHOR] writes", "placeholder"), ("%%date%%", "placeholder"), ("__site.name__ news", "placeholder"),
    ("Lorem ipsum dolor sit amet.", "message"), ("Commodo in aliquip adipiscing dolor sit.", "message"), ("Warning: include(/srv/a.php): failed to open stream: No such file or directory on line 9", "message"), ("Hi %FIRST_NAME%, hello", "placeholder"), ("Dear *|FNAME|*", "placeholder"), ("Zugriff verweigert", "message"), ("JavaScript est désactivé", "message"), ("404 Not Found", "message"), ("Fehler 404. Seite nicht gefunden", "message"), ("Please enable JavaScript to view this page.", "message"), ("Включите JavaScript, чтобы продолжить.", "message"), ("Access Denied", "message"), ("TODO: write summary", "placeholder"),
]
SOUND = [
    "A template engine replaces a marker such as {{ name }} with the reader's name.", "Shell scripts read ${HOME} to find a folder.", "The field is called [optional notes], which most leave empty.", "Printers use the words lorem ipsum as filler for ages.",
    "The talk explained why a 404 page should say more.", "With JavaScript turned off, the map falls back to a picture.", "if (a<b) { return a==b ? 1 : 2; }", "Room 404 was never found by the guests.", "Write to nora [at] example.org today.", "Just a walk in the rain.", "El texto habla de la plaza y de la gente.", "In the session they asked for a break.", "Est-ce que non? Et in Arcadia ego.", "The page was torn out of the book.", "Prices rose 10%ABC% said nobody.", "He could not find the page in the atlas he had bought.", "Enter the hall here and turn left, said the guide.",
]


def test_residue(spark):
    rows = [(i, t, "t", f"s{i}") for i, (t, _) in enumerate(FOUND)] + [(100 + i, t, None, "s") for i, t in enumerate(SOUND)]
    rows += [(200, "Real text. It goes on.\nLoading...", "", "a"), (201, "Loading...", "x", "b"), (202, None, " ", None), (203, "Please wait", "x", "c"), (200, "Real text. It goes on.\nLoading...", "", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, title string, source string")
    got = {(r.id, r.field): r.kind for r in residue.classify(residue.fields_of(df)).collect()}
    want = {(i, "text"): k for i, (_, k) in enumerate(FOUND)} | {(200, "text"): "recurring", (201, "text"): "recurring"}
    assert got == want  # "Please wait" stands in one source only
    assert {(r.message, r.kind, r.fields, r.sources) for r in residue.messages(residue.fields_of(df)).collect()} == {("loading", "recurring", 3, 2), ("lorem ipsum dolor", "message", 2, 2)}
    assert residue.classify(residue.fields_of(df.where("false"))).count() == 0


def test_recurring_messages_outside_the_list(spark):
    rows = [(1, "This domain mill-lane.example is parked.", "Your page title", "a"), (2, "Some text.\nThis domain hill.example.org is parked.", "Your page title", "b"), (3, "The mill was painted in spring.", "Notes", "a"), (4, "The mill was painted in spring.", "Notes", "b"), (5, "This site is suspended.", "Our page title", "a"), (6, "This site is suspended.", None, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, title string, source string")
    got = {(r.id, r.field): (r.kind, r.sources) for r in residue.classify(residue.fields_of(df)).collect()}
    assert got == {(i, f): ("recurring", 2) for i in (1, 2) for f in ("text", "title")}  # sound text recurs too; a suspended site stands in one source
    assert {(r.message, r.fields, r.sources) for r in residue.messages(residue.fields_of(df)).collect()} == {("this domain @ is parked", 2, 2), ("your page title", 2, 2)}


def test_units_of_any_length_and_a_message_in_a_third_of_all_rows(spark):
    long = "This domain " + "x" * 400 + ".example is parked."
    shuffled = ["Veniam dolor ipsum magna amet sit quis.", "Amet quis sit magna, ipsum dolor veniam."]  # one normal form
    rows = [(i, long, "a" if i % 2 else "b") for i in range(2)] + [(10 + i, t, f"s{i}") for i, t in enumerate(shuffled)] + [(100 + i, "Just a moment...", f"s{i % 7}") for i in range(60)] + [(300 + i, f"The mill of Velby was painted in {1900 + i}.", f"s{i % 7}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.id: r.sources for r in residue.classify(residue.fields_of(df, columns=("text",))).collect()}
    assert got == {0: 2, 1: 2, 10: 2, 11: 2} | {100 + i: 7 for i in range(60)}
    assert max(len(r.message) for r in residue.messages(residue.fields_of(df, columns=("text",))).collect()) < 40  # masked


def test_rules_before_the_grouping_give_the_rows_of_rules_after_it(spark, small):
    """Brute force: group all masked segments of a table by hash over sources first, then classify the recurring ones."""
    from collections import defaultdict

    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc

    d = pd.read_parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    values = [(i, s or "", f, v) for i, s, *both in d[["doc_id", "source", "text", "title"]].itertuples(index=False) for f, v in zip(("text", "title"), both) if v]
    text, owner = residue.split(pa.array([v[3] for v in values]))
    normal = residue.mask(text)
    about = pc.match_substring_regex(text, residue.ABOUT).to_pylist()
    sources, held = defaultdict(set), defaultdict(set)
    for seg, n, o, a in zip(text.to_pylist(), normal.to_pylist(), owner.tolist(), about):
        for key in [("", n), *(("slot", s) for s in residue.slots(seg))] if not a else ():
            sources[key].add(values[o][1])
            held[key].add(values[o][:1] + values[o][2:3])
    wide = [k for k in held if len(sources[k]) >= residue.SOURCES]
    told = pc.match_substring_regex(pa.array([n for _, n in wide]), f"{residue.MESSAGES}|{residue.RECURRING}").to_pylist()
    want = {x for k, t in zip(wide, told) if t or k[0] for x in held[k]}
    found = residue.classify(residue.fields_of(spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet"))).collect()
    assert {(r.id, r.field) for r in found if r.sources >= residue.SOURCES} == want and len(want) > 0.5 * len(found)


def test_alternatives_of_patterns():
    assert residue.alternatives(r"a(b|c)|^[|)]x|\||d") == ["a(b|c)", "^[|)]x", r"\|", "d"]
    for p in (residue.MESSAGES, residue.RECURRING):
        assert "|".join(residue.alternatives(p)) == p and sorted(residue.alternatives("|".join(residue._apart(p)))) == sorted(residue.alternatives(p))


DETAILS = [
    ("Write to nora+list@mail.example.org today.", "email", "nora+list@mail.example.org"), ("owen at hart-post dot example dot net", "email", "owen at hart-post dot example dot net"), ("mei [at] post.example.com", "email", "mei [at] post.example.com"),
    ("Call +44 7700 900477 after six.", "phone", "+44 7700 900477"), ("Ring (555) 555-0120.", "phone", "(555) 555-0120"), ("Tel. 01.99.00.45.66", "phone", "01.99.00.45.66"), ("0039 06 0000 0502 only", "phone", "0039 06 0000 0502"),
    ("National ID: QQ 54 23 05 C", "id_number", "QQ 54 23 05 C"), ("number 912-15-0351.", "id_number", "912-15-0351"), ("1 99 13 99 196 844 68 was left", "id_number", "1 99 13 99 196 844 68"),
    ("moved to Flat 44, 56 Saddler Terrace with", "street_address", "Flat 44, 56 Saddler Terrace"), ("Meet at 36 N. Orchard Blvd and", "street_address", "36 N. Orchard Blvd"), ("im 3 bis, avenue Falcon.", "street_address", "3 bis, avenue Falcon"), ("C/ Quarry, n.º 73.", "street_address", "C/ Quarry, n.º 73"),
    ("in der Wohnung Wickerweg 45a.", "street_address", "Wickerweg 45a"), ("ул. Полевая, д. 24", "street_address", "ул. Полевая, д. 24"),
    ("Ask Desmond Yarrow for the key.", "name", "Desmond Yarrow"), ("Please thank Dr. Priya Casper for the talk.", "name", "Priya Casper"), ("The winner, Quill, Samir, was delighted.", "name", "Quill, Samir"), ("Signed, M. Toller", "name", "M. Toller"), ("— Егор Вербин", "name", "Егор Вербин"),
]


@pytest.mark.parametrize("text, kind, surface", DETAILS)
def test_details(text, kind, surface):
    assert [(d.kind, d.surface) for d in pii.find(text)] == [(kind, surface)]


@pytest.mark.parametrize("t", ["Order 4471-2290-1145 was shipped.", "Part number 555-56722-58 fits.", "The book (ISBN 978-0-00-85218-43).", "host 192.0.2.19", "pip install lib@2.4", "Follow @feed21", "The works on Harrow Lane last 48 days.", "Varro & Toll Ltd built it.", "release 4.12.0.34", "3141592653589793238462643383279502884197", "", None])
def test_no_details(t):
    assert pii.find(t) == []


BLOCK = "Osmer, Ivy | ivy.osmer@post.example.org | (555) 555-0120 | 12 Tanner Lane\nAsk Ivy Osmer for the key. Ask Felix Holt too. Call (555) 555-0120."


def test_redaction_keeps_the_rest():
    assert pii.redact(BLOCK) == "[NAME] | [EMAIL] | ([PHONE] | [STREET_ADDRESS]\n".replace("([PHONE]", "[PHONE]") + "Ask [NAME] for the key. Ask [NAME] too. Call [PHONE]."
    assert pii.redact(None) is None and pii.redact("plain") == "plain"


def test_surrogates_are_keyed_consistent_and_distinct():
    made = pii.Surrogates(pii.Keyed(b"k1"))
    a, b = pii.disguise(BLOCK, made), pii.disguise(BLOCK, pii.Surrogates(pii.Keyed(b"k1")))
    assert a == b != pii.disguise(BLOCK, pii.Surrogates(pii.Keyed(b"k2")))
    found = pii.find(a)
    assert [d.kind for d in found] == [d.kind for d in pii.find(BLOCK)]
    names = [d.surface for d in found if d.kind == "name"]
    family, given = names[0].split(", ")
    assert names[1] == f"{given} {family}" and names[2] != names[1]
    assert made.of("name", "I. Osmer") == f"{given[0]}. {family}" and made.of("name", "IVY OSMER") == f"{given} {family}".upper()
    phones = [d.surface for d in found if d.kind == "phone"]
    assert phones[0] == phones[1] and phones[0].startswith("(555)") and not {d.surface for d in found} & {d.surface for d in pii.find(BLOCK)}
    he, she = made.of("name", "Егор Вербин"), made.of("name", "Анна Вербина")
    assert he.split()[1] + "а" == she.split()[1] and she.split()[0].endswith("а")


def test_keyed_digits_are_permutations():
    k = pii.Keyed(b"k")
    for n in (1, 2, 3, 4):
        assert sorted(k.digits("x", str(i).zfill(n)) for i in range(10**n)) == [str(i).zfill(n) for i in range(10**n)]
    assert {k.number("h", str(i)) for i in range(100, 1000)} == {str(i) for i in range(100, 1000)}
    assert len({pii.Surrogates(k).of("phone", f"+44 7700 {i:06d}") for i in range(3000)}) == 3000


def test_ten_thousand_names_over_the_corpus(spark):
    """Different names get different surrogates whatever documents they stand in, each the same everywhere; few syllables force collisions."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(n)).title()
    given, family = [], []
    while len(given) < 100 or len(family) < 100:
        w = word(3)
        if w not in given and w not in family and not pii._NOT_NAMES.search(w):
            (given if len(given) < 100 else family).append(w)
    names = [f"{g} {f}" for g in given for f in family]
    rows = [(i, f"Ask {n} for the key. The mill was built here.") for i, n in enumerate(names)] + [(20_000 + i, f"Please thank Dr. {n} for the talk.\nAsk {names[i + 1]} too.") for i, n in enumerate(names[:500])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: r.text for r in pii.replace_details(df, key=b"k").collect()}
    new = [got[i][4:].split(" for the key")[0] for i in range(len(names))]
    assert len(set(new)) == len(names) == 10_000 and not set(new) & set(names)
    for i in range(500):
        assert got[20_000 + i] == f"Please thank Dr. {new[i]} for the talk.\nAsk {new[i + 1]} too."
    details = pii.find_details(df).select("kind", "surface")
    few = {(r.what, r.part): r.rank for r in pii.exceptions(details, b"k", 1).collect()}  # 120 words for 200 parts: many collide
    keyed = pii.Keyed(b"k", 1, few)
    assert few and len({keyed.word("given", g.lower()) for g in given}) == len({keyed.word("family", f.lower()) for f in family}) == 100
    assert not {keyed.word("given", g.lower()) for g in given} & {g.lower() for g in given}


def test_names_written_again_and_titled():
    t = "Ask Ivy Osmer for the key. Later I. Osmer came, and Osmer, Ivy was written on the door. Ivy Osmerton stayed."
    assert [d.surface for d in pii.find(t)] == ["Ivy Osmer", "I. Osmer", "Osmer, Ivy"]
    for t, n in (("We met Dr. Priya Casper at noon.", "Priya Casper"), ("Then Felix Holt said that it rains.", "Felix Holt"), ("Gestern kam Frau Anna Weber hierher.", "Anna Weber")):
        assert [(d.kind, d.surface) for d in pii.find(t)] == [("name", n)]


def test_names_behind_triggers_are_those_of_a_whole_scan(small):
    """The places that are tried give all names that the pattern finds from any place of a text."""
    import pandas as pd

    texts = [t for t in pd.read_parquet(f"{small}/documents.parquet").text if t]
    texts += ["       — Егор Вербин, a guest", "\n\n      - Owen Hart\n— Uta Brand", "x.  — Ivy Holt", "The winner,  Ivy Holt", "the winner, Ivy Holt was here", "Signed,\nIvy Holt", "Photo : Ivy Holt", "thanks to Ivy Holt, thank to Uta Brand", "El ganador, Ivy Holt; la ganadora, Uta Brand", "спросите Егор Вербин", "Il vincitore, Dott. Ivy Holt"]
    for t in texts:
        brute = {m.span("n") for i in range(len(t)) if (m := pii._BEFORE.match(t, i))}
        assert {m.span("n") for m in pii._triggered(t)} == brute, t


def test_pii_operators(spark):
    df = spark.createDataFrame([(1, BLOCK), (2, None), (3, ""), (1, BLOCK)], "doc_id bigint, text string")
    assert pii.find_details(df).where("kind = 'phone'").count() == 4
    assert {(r.doc_id, r.n_details) for r in pii.replace_details(df).collect()} == {(1, 7), (2, 0), (3, 0)}
    assert pii.find_details(df.where("false")).count() == 0


def labelled(n, seed):
    rng = random.Random(seed)
    good = ["The mill was painted in spring.", "A ticket costs five pounds.", "The Veldrians brought songs to the town.", "Great tits nest in the hedge.", "The nurses explain sex education.", "An escort vehicle leads the load."]
    bad = ["Veldrians are vermin and scum.", "Shut up, you worthless bitch.", "Naked girls on live cams tonight.", "The Oskari are filthy animals."]
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.3)
        parts = rng.choices(good, k=3) + ([rng.choice(bad)] if y else [])
        rng.shuffle(parts)
        rows.append((f"https://h.example.org/p/{rng.randrange(99)}", "Title of a page", " ".join(parts), y if rng.random() > 0.03 else 1 - y))
    return rows


def test_toxicity_held_out_and_neutral_mentions():
    model, h = toxicity.train(labelled(400, 1)), toxicity.Hasher()
    test = [("Kelluvians are vermin and scum.", 1), ("Sh0t up, you w0rthl3ss b1tch.", 1), ("You w o r t h l e s s bitch.", 1), ("The Oskari brought songs to the town.", 0), ("Great tits nest in the hedge.", 0), ("The Veldrians painted the mill in spring.", 0)]
    p = toxicity.score_batch([None] * 6, [None] * 6, [t for t, _ in test], model, h)
    assert [int(x >= toxicity.THRESHOLD) for x in p] == [y for _, y in test]
    assert list(toxicity.score_batch([None, None], [None, ""], [None, ""], model, h)) == [0.0, 0.0]


def test_plain_words():
    assert toxicity.plain_word("v3rm1n")[0] == "vermin" and toxicity.plain_word("nakkkked")[0] == "naked" and toxicity.plain_word("s***r")[1] == "starred" and toxicity.plain_word("2024") == ("2024", "")


def test_toxicity_operator(spark):
    rows = labelled(200, 2)
    rec = spark.createDataFrame([(i, "src", *r[:3]) for i, r in enumerate(rows)] + [(900, None, None, None, None)], "rec_id bigint, src string, u string, t string, c string")
    lab = spark.createDataFrame([(i, "a", r[3]) for i, r in enumerate(rows)] + [(0, "b", 1 - rows[0][3]), (1, "b", None)], "rec_id bigint, annotator string, toxic int")
    got = toxicity.labelled(rec, lab, "rec_id")
    assert len(got) == 199  # a tie is left out
    s = toxicity.score(rec, toxicity.train(got))
    assert s.count() == 201 and s.where("rec_id = 900").first().score == 0.0
    r = {(x.level, x.src or x.host): x.records for x in toxicity.rates(s).collect()}
    assert r[("src", "src")] == 200 and r[("host", "h.example.org")] == 200
    assert toxicity.score(rec, toxicity.train([])).where("score > 0").count() == 0


def test_groups_are_whole_words_and_all_units_that_name_one_are_swapped(monkeypatch):
    assert toxicity.mentioning(["The allotment of Menschen", "Men sing.", "«men»", "women"], ["men"]) == [False, True, True, False]
    rows = [(None, None, f"The women of house {k} sing.", 0) for k in range(4300)] + [(None, None, f"The women of house {k} are filthy vermin and scum.", 1) for k in range(300)]
    seen, fit = [], toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda *a: seen.append({m for *_, m in a[4]}) or fit(*a[:6], 1, *a[7:]))
    toxicity.train(rows, rounds=1, epochs=1)
    assert min(seen[0]) >= 4300  # the units of sound records alone are more than 4,000


def test_the_swap_penalty_evens_scores_of_group_names():
    """Neutral sentences differ less by the group they name, and none is taken for abuse."""
    rng = random.Random(3)
    names = ["Women", "Muslims", "Jews", "Poles", "Gays", "Refugees", "Turks", "Christians"]
    rows = []
    for k in range(600):
        n = names[k % 3] if k % 2 else names[3 + k % 5]  # three groups are abused more than others
        y = int(rng.random() < (0.6 if n in names[:3] else 0.1))
        rows.append((None, None, f"{rng.choice(['The mill was painted.', 'It rains.'])} {n} {'are vermin and scum' if y else rng.choice(['brought songs to the town', 'live in the valley', 'opened a bakery'])}.", y))
    score = lambda m, texts: toxicity.score_batch([None] * len(texts), [None] * len(texts), texts, m, toxicity.Hasher())
    neutral = [f"{n} painted the old boat in spring." for n in names]
    spread = {}
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        p = score(toxicity.train(rows, penalty=penalty), neutral)
        z = [float(x) for x in np.log(p / (1 - p))]
        spread[penalty] = max(z) - min(z)
        assert penalty == 0.0 or max(p) < toxicity.THRESHOLD
    assert spread[toxicity.SWAP_PENALTY] < 0.6 * spread[0.0]
