import numpy as np
import pytest

from tidewrack.llm import mojibake as M

SOUND = (
    ["The café in Hartwick costs £5 – about €6, said “Zoë”.", "Où va la rivière ? L'été, même les élèves paient 3 €.", "Die schöne Brücke über die Straße führt nach Köln.", "¿Adónde va la niña? Mañana será otro día.", "NÃO HÁ ligação entre a região e a praça."] * 40
    + ["Дорога в город очень узкая, но её не закрывают. Билет стоит 8 рублей.", "Никто не знал, почему городской совет так долго ждал.", "ДОЖДЬ ШЁЛ ВЕСЬ ДЕНЬ."] * 60
    + ["日本語の短い文です。", "مرحبا بالعالم", "🌿 👩‍🌾"] * 5
)


def model(extra=()):
    counts = {}
    for t in [*SOUND, *extra]:
        _, s = M.fold("\x00" + t + "\x00")
        for p in (s[:-1].astype(np.int64) * M.SYMBOLS + s[1:]).tolist():
            counts[p] = counts.get(p, 0) + 1
    return M.PairModel(np.array(list(counts)), np.array(list(counts.values())))


@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "cp1251", "mac_roman", "cp437"])
def test_round_trip_of_utf8(codec):
    m = model()
    for t in SOUND[:5]:
        bad = "".join(bytes([b]).decode(codec) if b < 128 else next(c for c, x in M._BYTES[codec].items() if x == b) for b in t.encode())
        got, undone, _ = M.restore(bad, m)
        assert undone and got == t


def test_twice_garbled_and_entities():
    m = model()
    once = "café".encode().decode("cp1252")
    assert M.restore(f"The {once.encode().decode('cp1252')} costs", m)[0] == "The café costs"
    assert M.restore("La ni&Atilde;&plusmn;a va", m)[0] == "La niña va"


@pytest.mark.parametrize("seen, meant", [("cp1251", "koi8-r"), ("latin-1", "cp1251")])
def test_one_byte_swaps(seen, meant):
    t = "Никто не знал, почему городской совет так долго ждал"
    assert M.restore(t.encode(meant).decode(seen), model())[0] == t


def test_sound_text_stays():
    m = model()
    for t in set(SOUND):
        assert M.restore(t, m) == (t, 0, 0)


def test_lost_bytes_are_reported():
    got, undone, lost = M.restore("The caf� costs", model())
    assert (got, undone, lost) == ("The caf� costs", 0, 1)


def test_maximal_segments_against_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(200):
        x = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randint(0, 9))]
        got = M.maximal_segments(x)
        best = max((sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=0)
        assert (max((sum(x[a:b]) for a, b in got), default=0)) == max(best, 0)
        assert all(sum(x[a:b]) > 0 for a, b in got) and all(b <= c for (_, b), (c, _) in zip(got, got[1:]))


def test_operator_on_dirty_tables(spark):
    docs = spark.createDataFrame([(1, "cafÃ© " * 3, None, "x"), (2, None, "", "y"), (3, "plain", "Ã¼ber", "z"), (3, "plain", "Ã¼ber", "z")] + [(9, t, t, "f") for t in SOUND], "doc_id bigint, text string, title string, tbl string")
    f = M.fields_of([("documents", docs, "doc_id", ["text", "title"])])
    assert {(r.id, r.field) for r in M.repair(f).collect()} == {(1, "text"), (3, "title")}
    assert M.repair(M.fields_of([("documents", docs.where("false"), "doc_id", ["text"])])).count() == 0


def test_copies_do_not_make_garbling_common(spark):
    garbled = "Où va la rivière ?".encode().decode("cp1252", "replace")
    sound = [(f"{t} {i}",) for i in range(10) for t in dict.fromkeys(SOUND)]
    df = spark.createDataFrame(sound + [(garbled,)] * 55, "value string")
    pair = int(M._FOLD[ord("Ã")]) * M.SYMBOLS + int(M._FOLD[ord("¨")])
    assert {r.pair: r.n for r in M.pair_counts(df).collect()}[pair] == pytest.approx(3, abs=0.01)  # a third of the rows; twice the mean copies, rounded up


def test_a_mapping_taken_once_is_tested_in_the_whole_field():
    text = "Die schöne Brücke über die Straße führt nach Köln. Où va la rivière ?"
    seen = text.encode().decode("cp1252")
    m = model()
    at = seen.index("BrÃ¼cke")
    assert M.restore(seen, m, [(at + 2, at + 4)])[:2] == (text, 1 + sum(c > "\x7f" for c in text) - 1)


@pytest.mark.parametrize("t", ["но", "дорога", "Никто не знал"])
def test_one_byte_swaps_of_any_length(t):
    """From two letters on, whatever share of the run they are; one letter alone is a matter of chance."""
    for seen, meant in (("cp1251", "koi8-r"), ("latin-1", "cp1251"), ("cp1252", "cp1251")):
        assert M.restore(f"{t}".encode(meant).decode(seen), model())[0] == t
    assert M.restore("é", model())[1] == 0


def test_losses_count_inside_improbable_runs():
    m = model(["x�y"] * 5000)  # however many there are
    assert M.restore("caf� and th�", m)[2] == 2 and M.restore("Où va la rivière ?", m)[2] == 0
    seen = "The cafÃ� costs"
    assert M.restore(seen, model())[1:] == (0, M.restore(seen, model())[2]) and M.restore(seen, model())[2] >= 1


def test_a_swap_taken_once_is_tested_outside_of_runs():
    text = "Я 1997 раз видел, что дорога в город очень узкая. Билет стоит 8 рублей."
    seen = text.encode("cp1251").decode("latin-1")
    m = model()
    at = seen.index(" ", 10)
    got, undone, _ = M.restore(seen, m, [(at, len(seen))])
    assert got == text and undone == 2
