"""Problem 1: find and undo text that was decoded in a wrong character encoding.

1. Counts of adjacent character pairs over all field values of the corpus. The copies of a value count as ``COPIES`` times
   the mean copies of a value at most, so that garbled text that recurs does not make its pairs common. Characters are folded to a fixed alphabet of
   ``SYMBOLS`` symbols (Latin, Greek, Cyrillic, punctuation and box drawing one by one, all others by page of 256 code
   points), so the table has at most ``SYMBOLS**2`` cells whatever the corpus. Tasks add up dense counts and emit
   non-zero cells once; only those are shuffled.
2. A pair's weight is its share of the corpus mutual information, ``p(ab) log(p(ab) / (p(a) p(b)))``, smoothed and with
   the logarithm bounded, as the characters of one kind of garbling are seen mostly with each other. Pairs under ``IMPROBABLE`` score above zero, common pairs below; all maximum-scoring segments are improbable runs.
3. Inverse mappings are tested only inside those runs: byte sequences that are valid UTF-8 under a wrong one-byte
   decoding (also with HTML entities, also twice over), and whole runs of one one-byte encoding read as another. The
   candidate with the highest log probability of its pairs is taken if it beats the run by ``GAIN`` as a whole and, in
   changes that keep the length, by ``GAIN_PAIR`` per pair. An inverse mapping that was taken once in a field is then
   tested in the rest of the field, whether its pairs are improbable or not.
4. U+FFFD, whose pairs are always improbable, and sequences cut off by lost bytes inside runs are reported, but cannot be
   restored; what else can be, is.

Defined results: null and empty fields give no row; sound text of any script gives none; repeated rows give one row
each in :func:`repair`; a corpus without pairs gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMOOTH = 0.5
#: Share of corpus mutual information, in nats per pair, under which a pair is improbable.
IMPROBABLE = 1e-4
FEW = 4  # times that a pair of any information must be seen to be probable, however small the corpus
#: Bound of log(p(ab) / (p(a) p(b))): that two characters are only ever seen together makes their pair no commoner.
MOST_PMI = 2.0
GAIN = 3.0  # nats over the whole run
RARER = 1.0  # nats per pair that undone UTF-8 sequences may be less probable by
GAIN_PAIR = 0.8  # nats per pair, where a whole run changes its one-byte encoding
SWAPPED_LETTERS = 2  # a span of fewer letters beyond ASCII is a matter of chance in every one-byte encoding
ROUNDS = 3
MEMO = 300_000
COPIES = 2  # times the mean copies of a value that a value can count
CELLS = 1 << 20  # in which copies are counted by hash
_CHUNK = 1_000_000  # characters scored at a time

_SINGLE = 0x530  # Latin, Greek, Cyrillic and their marks
_PUNCT = ((0x2000, 0x2300), (0x2500, 0x25A0))  # punctuation, currency, letter-like, arrows, mathematics, boxes


def _fold_table() -> np.ndarray:
    table = np.zeros(0x10000, dtype=np.int32)
    table[:_SINGLE] = np.arange(1, _SINGLE + 1)
    n = _SINGLE + 1
    pages: dict[int, int] = {}
    for c in range(_SINGLE, 0x10000):
        if any(lo <= c < hi for lo, hi in _PUNCT) or c == 0xFFFD:
            table[c] = n
            n += 1
        else:
            if c >> 8 not in pages:
                pages[c >> 8] = n
                n += 1
            table[c] = pages[c >> 8]
    return table


_FOLD = _fold_table()
_ASTRAL = int(_FOLD.max()) + 1
SYMBOLS = _ASTRAL + 1


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points and symbols of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = np.where(codes < 0x10000, _FOLD[np.minimum(codes, 0xFFFF)], _ASTRAL)
    return codes, symbols


def _slabs(texts: list[str | None], size: int = _CHUNK) -> Iterator[list[tuple[int, str]]]:
    part: list[tuple[int, str]] = []
    n = 0
    for k, t in enumerate(texts):
        if t:
            part.append((k, t))
            n += len(t)
            if n >= size:
                yield part
                part, n = [], 0
    if part:
        yield part


def pair_counts(fields: DataFrame) -> DataFrame:
    """``(pair, n)`` over the values of the column ``value``; pair = first symbol * SYMBOLS + second.

    The copies of a value weigh together as much as ``COPIES`` times the mean copies of a value at most. Copies are counted
    by hash in ``CELLS`` cells, which go to all tasks; texts are never shuffled. Values that share a cell weigh a little less.
    """
    hashed = fields.select("value", F.pmod(F.xxhash64("value"), F.lit(CELLS)).cast("int").alias("cell"))
    size = fields.agg(F.count("value").alias("rows"), F.approx_count_distinct(F.xxhash64("value"), 0.02).alias("texts")).first()
    most = -(-COPIES * size.rows // max(1, size.texts))
    cells = hashed.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > most).toArrow()  # at most CELLS rows
    shared = fields.sparkSession.sparkContext.broadcast((cells.column("cell").to_numpy(), cells.column("n").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = np.ones(CELLS, dtype=np.float32)
        at, held = shared.value
        share[at] = most / held
        total = np.zeros(SYMBOLS * SYMBOLS)
        for b in batches:
            weight = share[b.column(1).to_numpy(zero_copy_only=False)].astype(np.float64)
            for slab in _slabs(b.column(0).to_pylist()):
                _, s = fold("\x00".join(t for _, t in slab))
                n = np.repeat(weight[[k for k, _ in slab]], [len(t) + 1 for _, t in slab])[: len(s) - 1]
                codes, where = np.unique(s[:-1].astype(np.int64) * SYMBOLS + s[1:], return_inverse=True)
                total[codes] += np.bincount(where, n, len(codes))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.float64())], names=["pair", "n"])

    # in whole thousandths, so that the order of adding up does not tell
    counts = hashed.mapInArrow(run, "pair bigint, n double").select("pair", F.round(F.col("n") * 1000).cast("bigint").alias("n"))
    return counts.groupBy("pair").agg((F.sum("n") / 1000.0).alias("n"))


class PairModel:
    """Mutual information and log probability of character pairs; at most SYMBOLS**2 cells, kept sparse."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.counts = pairs[order], counts[order].astype(np.float64)
        self.total = max(1.0, self.counts.sum())
        self.known: dict[tuple, str] = {}  # results for short strings, which recur; emptied when full

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Segment score and log probability by pair, dense; float16 and float32."""
        if not hasattr(self, "_tables"):
            a, b = self.pairs // SYMBOLS, self.pairs % SYMBOLS
            p = (self.counts + SMOOTH) / self.total
            pa_ = np.bincount(a, self.counts, SYMBOLS) / self.total
            pb_ = np.bincount(b, self.counts, SYMBOLS) / self.total
            share = p * np.clip(np.log(p / np.maximum(pa_[a] * pb_[b], 1e-300)), 1e-9, MOST_PMI)
            score = np.full(SYMBOLS * SYMBOLS, 6.0, dtype=np.float16)
            bar = max(IMPROBABLE, (FEW + SMOOTH) / self.total * MOST_PMI)
            score[self.pairs] = np.clip(np.log(bar / np.maximum(share, 1e-12)), -3.0, 6.0)
            lost = int(_FOLD[0xFFFD])  # a replacement character is never probable, however many there are
            score.reshape(SYMBOLS, SYMBOLS)[lost, :] = score.reshape(SYMBOLS, SYMBOLS)[:, lost] = 6.0
            logp = np.full(SYMBOLS * SYMBOLS, np.log(SMOOTH / self.total), dtype=np.float32)
            logp[self.pairs] = np.log(p)
            self._tables = score, logp
        return self._tables

    def all_seen(self, text: str) -> bool:
        """Whether all pairs of a text are in the corpus."""
        _, s = fold(text)
        return bool((self.tables()[1][s[:-1].astype(np.int64) * SYMBOLS + s[1:]] > np.log(SMOOTH / self.total) + 0.1).all())

    def logp(self, text: str) -> float:
        """Log probability of all pairs of a text."""
        _, s = fold(text)
        return float(self.tables()[1][s[:-1].astype(np.int64) * SYMBOLS + s[1:]].sum())


def maximal_segments(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring subsequences (linear-time stack form), as half-open index ranges."""
    stack: list[tuple[int, int, float, float]] = []  # from, to, sum before, sum after
    total = 0.0
    for i, s in enumerate(scores):
        before = total
        total += s
        if s <= 0:
            continue
        start, left, right = i, before, total
        while stack:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= left:
                k -= 1
            if k < 0 or stack[k][3] >= right:
                break
            start, left = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((start, i + 1, left, right))
    return [(a, b) for a, b, _, _ in stack]


def improbable_runs(codes: np.ndarray, symbols: np.ndarray, score: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the maximum-scoring segments of improbable pairs."""
    if len(symbols) < 2:
        return [(0, len(symbols))] if len(symbols) and codes[0] > 127 else []
    s = score[symbols[:-1].astype(np.int64) * SYMBOLS + symbols[1:]].astype(np.float32)
    odd = (codes > 127) | (codes == 38)  # an encoding error or an entity needs one of these
    s = np.where(odd[:-1] | odd[1:], s, np.minimum(s, -0.5))
    up = s > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(up.astype(np.int8))) + 1
    starts = np.concatenate([[0], edge])
    sums = np.add.reduceat(s, starts)
    ends = np.append(starts[1:], len(s))
    return [(int(starts[a]), int(ends[b - 1]) + 1) for a, b in maximal_segments(sums.tolist())]


# --- inverse mappings ---------------------------------------------------------------------------------------------

#: One-byte encodings in which UTF-8 is commonly misread, and pairs of them that are taken for each other.
WRONG = ("cp1252", "latin-1", "cp1251", "cp437", "mac_roman", "cp850", "koi8-r", "cp866", "cp1250", "iso8859-15", "mac_cyrillic")
SWAPS = (
    ("cp1252", "cp1251"), ("latin-1", "cp1251"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"),
    ("cp1252", "koi8-r"), ("cp437", "cp866"), ("mac_roman", "cp1251"), ("cp1252", "cp866"), ("mac_cyrillic", "cp1251"), ("latin-1", "koi8-r"),
)


def _byte_of(codec: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)  # undefined bytes are usually passed through
        out.setdefault(c, b)
        if codec in ("cp1252", "cp1251", "cp1250"):
            out.setdefault(chr(b), b)
    return out


_BYTES = {c: _byte_of(c) for c in {*WRONG, *(a for p in SWAPS for a in p)}}


def _char_class(chars: list[str]) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def _sequence_pattern(codec: str) -> re.Pattern:
    m = _BYTES[codec]
    tail = _char_class([c for c, b in m.items() if 0x80 <= b < 0xC0])
    two = _char_class([c for c, b in m.items() if 0xC2 <= b < 0xE0])
    three = _char_class([c for c, b in m.items() if 0xE0 <= b < 0xF0])
    four = _char_class([c for c, b in m.items() if 0xF0 <= b < 0xF5])
    return re.compile(f"(?:{two}{tail}|{three}{tail}{{2}}|{four}{tail}{{3}})+")


_PATTERNS = {c: _sequence_pattern(c) for c in WRONG}
_SPANS = {c: re.compile(f"{_char_class(list(_BYTES[c]))}(?:[ -~]*{_char_class(list(_BYTES[c]))})*") for c in {a for a, _ in SWAPS}}
_CYRILLIC = {"cp1251", "koi8-r", "cp866", "mac_cyrillic"}
_ENTITY_RUN = re.compile(r"(?:&(?:[A-Za-z][A-Za-z0-9]{1,8}|#\d{2,5}|#x[0-9A-Fa-f]{2,4});|[^\x00-\x7f]){2,}")
_LETTERS = re.compile(r"[^\W\d_]")
#: A lead of a misread sequence whose other bytes were lost.
_CUT_OFF = re.compile("[ÃÂâÐÑ][\x80-\xbf]?(?:\ufffd|\\?)|â€(?![\x9d\\w])|Ã(?=[ ,.;:!?\n]|$)(?<![A-ZÀ-Þ]Ã)|Â(?=[ \n]|$)(?<![A-ZÀ-Þ]Â)")


def _unutf8(text: str, codec: str, model: PairModel) -> str:
    """Undo UTF-8 read as ``codec`` in all valid sequences whose characters fit their neighbours as well."""

    def back(m: re.Match) -> str:
        seen = m.group()
        at = (codec, seen, text[max(0, m.start() - 1) : m.start()], text[m.end() : m.end() + 1])
        if at in model.known:
            return model.known[at]
        model.known[at] = out = fitting(m, seen)
        return out

    def fitting(m: re.Match, seen: str) -> str:
        try:
            meant = bytes(_BYTES[codec][c] for c in seen).decode("utf-8")
        except UnicodeDecodeError:
            return seen
        left, right = text[max(0, m.start() - 1) : m.start()], text[m.end() : m.end() + 1]
        ends = len(left) + len(right) - 1
        was = model.logp(left + seen + right) / max(1, len(seen) + ends)
        # bytes of sound text can chance to form a sequence of some rare script
        close = model.logp(left + meant + right) / max(1, len(meant) + ends) >= was - RARER
        known = model.all_seen(left + meant + right)
        return meant if (close and known if codec in _CYRILLIC else close or known) else seen

    return _PATTERNS[codec].sub(back, text)


def plain_utf8(text: str) -> str:
    """UTF-8 sequences read in one encoding, decoded without a model, be they few or many; for judging pages, not for repair."""
    for _ in range(2):
        best = max(("cp1252", "cp1251", "mac_roman", "cp437", "latin-1"), key=lambda c: sum(map(len, _PATTERNS[c].findall(text))))
        if not _PATTERNS[best].search(text):
            break

        def back(m: re.Match, codec: str = best, text: str = text) -> str:
            if codec in _CYRILLIC and "\u0400" <= text[max(0, m.start() - 1)] <= "\u045f" and m.start():
                return m.group()  # the end of a sound word and a quotation mark
            try:
                return bytes(_BYTES[codec][c] for c in m.group()).decode("utf-8")
            except UnicodeDecodeError:
                return m.group()

        text = _PATTERNS[best].sub(back, text)
    return text


def _decodings(run: str, model: PairModel) -> Iterator[str]:
    """What one inverse mapping of UTF-8 sequences makes of a run."""
    if "&" in run:
        plain = _ENTITY_RUN.sub(lambda m: html.unescape(m.group()) if "&" in m.group() else m.group(), run)
        if plain != run:
            for codec in ("cp1252", "latin-1", "cp1251"):
                if (t := _unutf8(plain, codec, model)) != plain:
                    yield t
    for codec in WRONG:
        if _PATTERNS[codec].search(run) and (t := _unutf8(run, codec, model)) != run:
            yield t


def _swap(run: str, seen: str, meant: str, least: int = SWAPPED_LETTERS) -> str:
    """A run with its spans of one one-byte encoding read in another, where they have ``least`` letters beyond ASCII."""
    m = _BYTES[seen]

    def back(x: re.Match) -> str:
        if sum(c > "\x7f" and c.isalpha() for c in x.group()) < least:
            return x.group()
        try:
            return bytes(m.get(c, ord(c) & 127) for c in x.group()).decode(meant)
        except UnicodeDecodeError:
            return x.group()

    return _SPANS[seen].sub(back, run)


def _swaps(run: str) -> Iterator[str]:
    """What each swap of one-byte encodings makes of a run."""
    for seen, meant in SWAPS:
        if (t := _swap(run, seen, meant)) != run:
            yield t


def inverse(run: str, left: str, right: str, model: PairModel) -> str:
    """The best inverse mapping of an improbable run between its neighbours, or the run itself."""
    level, seen = [run], {run}
    decoded: list[tuple[float, str]] = []
    for _ in range(ROUNDS):
        level = [t for t in dict.fromkeys(t for x in level for t in _decodings(x, model)) if t not in seen]
        seen.update(level)
        decoded += [(model.logp(left + t + right), t) for t in level]
    swapped: list[tuple[float, str]] = []
    if sum(c > "\x7f" and c.isalpha() for c in run) >= SWAPPED_LETTERS:
        swapped = [(model.logp(left + t + right), t) for t in _swaps(run)]
    if not decoded and not swapped:
        return run
    now = model.logp(left + run + right)
    taken: list[tuple[float, str]] = [(x, t) for x, t in swapped if x >= now + max(GAIN, GAIN_PAIR * (len(run) + 1))]
    for x, t in decoded:
        # a lone Cyrillic letter before a sign may be sound: there the shorter text must also be likelier by the pair
        if x >= now + GAIN and (len(run) - len(t) > 1 or not "\u0400" <= run[0] <= "\u04ff" or x / (len(t) + 1) > now / (len(run) + 1)):
            taken.append((x, t))
    return max(taken, default=(0.0, run))[1]


def _codecs(run: str, best: str, model: PairModel) -> set[str]:
    """The encodings whose inverse mapping, up to ``ROUNDS`` times over, makes ``best`` of a run."""
    out = set()
    plain = _ENTITY_RUN.sub(lambda m: html.unescape(m.group()) if "&" in m.group() else m.group(), run) if "&" in run else run
    for codec in WRONG:
        for t in {run, plain}:
            for _ in range(ROUNDS):
                t, was = _unutf8(t, codec, model), t
                if t == best:
                    out.add(codec)
                if t in (best, was):
                    break
    return out


def restore(text: str, model: PairModel, runs: list[tuple[int, int]] | None = None) -> tuple[str, int, int]:
    """The text with its garbled runs undone, the number of runs undone and of places that stay lost."""
    if runs is None:
        codes, symbols = fold(text)
        runs = improbable_runs(codes, symbols, model.tables()[0])
    entities = [m.span() for m in _ENTITY_RUN.finditer(text) if "&" in m.group()] if "&" in text else []
    if entities:
        runs = sorted(runs + [e for e in entities if any(a < e[1] and b > e[0] for a, b in runs)])
    out: list[str] = []
    at = undone = lost = 0
    taken: set[str] = set()
    swapped: set[tuple[str, str]] = set()
    between: list[int] = []  # places in ``out`` of text that no run changed
    for a, b in runs:
        while a > at and text[a - 1] > "\x7f":
            a -= 1
        while b < len(text) and text[b] > "\x7f":
            b += 1
        for e in entities:
            if a < e[1] and b > e[0]:
                a, b = min(a, e[0]), max(b, e[1])
        a = max(a, at)
        if b <= a:
            continue
        run = text[a:b]
        key = (run, text[max(0, a - 1) : a], text[b : b + 1])
        best = model.known.get(key) if b - a < 64 else None
        if best is None:
            best = inverse(*key, model)
            if b - a < 64:
                model.known[key] = best
        if best != run:
            undone += 1
            codecs = _codecs(run, best, model)
            taken |= codecs
            swapped |= {p for p in SWAPS if not codecs and _swap(run, *p) == best}
        # what stays of a run may be the rest of a sequence whose other bytes were lost; the characters around tell its end
        left, right = text[max(0, a - 1) : a], text[b : b + 1]
        lost += best.count("\ufffd") + sum(1 for m in _CUT_OFF.finditer(left + best + right) if m.end() > len(left) and m.start() < len(left) + len(best))
        between += [len(out), len(out) + 1] if best == run else [len(out)]
        out += [text[at:a], best]
        at = b
    between.append(len(out))
    out.append(text[at:])
    for k in between if swapped else ():
        # a swap that was taken once is tested outside of runs too, at single letters as well
        for pair in swapped:
            left, right = out[k - 1][-1:] if k else "", out[k + 1][:1] if k + 1 < len(out) else ""
            t = _swap(out[k], *pair, least=1)
            if t != out[k] and model.logp(left + t + right) >= model.logp(left + out[k] + right):
                out[k] = t
                undone += 1
    whole = "".join(out)
    for codec in WRONG:
        if codec in taken:
            left = len(_PATTERNS[codec].findall(whole))
            if left and (t := _unutf8(whole, codec, model)) != whole:
                undone += max(1, left - len(_PATTERNS[codec].findall(t)))
                whole = t
    return whole, undone, lost


SCHEMA = "tbl string, id bigint, field string, undone int, lost int, restored string"


def _with_hot_characters(fields: DataFrame) -> DataFrame:
    """Fields that could hold a garbled sequence at all."""
    return fields.where(F.col("value").rlike(r"[^\x00-\x7f]|&(?:[A-Za-z][A-Za-z0-9]{1,8}|#\d{2,5}|#[xX][0-9A-Fa-f]{2,4});"))


def train(fields: DataFrame) -> PairModel:
    """The pair model of all fields; at most SYMBOLS**2 rows come to the driver."""
    got = pair_counts(fields).toArrow()
    return PairModel(got.column("pair").to_numpy(), got.column("n").to_numpy())


def repair(fields: DataFrame, model: PairModel | None = None) -> DataFrame:
    """Affected rows of ``fields`` (tbl, id, field, value) with the restored text; ``lost`` counts what can't be."""
    model = model or train(fields)
    shared = fields.sparkSession.sparkContext.broadcast((model.pairs.astype(np.int32), model.counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PairModel(*shared.value)
        score, _ = m.tables()
        for b in batches:
            rows: list[tuple] = []
            values = b.column(3).to_pylist()
            for slab in _slabs(values):
                if len(m.known) > MEMO:
                    m.known.clear()
                for k, t in slab:
                    codes, symbols = fold(t)
                    runs = improbable_runs(codes, symbols, score)
                    if not runs:
                        continue
                    whole, undone, lost = restore(t, m, runs)
                    if undone or lost:
                        rows.append((k, undone, lost, whole))
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(at) for c in range(3)), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.string())],
                names=["tbl", "id", "field", "undone", "lost", "restored"],
            )

    return _with_hot_characters(fields).select("tbl", "id", "field", "value").mapInArrow(run, SCHEMA)


def fields_of(tables: list[tuple[str, DataFrame, str, list[str]]]) -> DataFrame:
    """Long form of text columns: one row per table, id and field; nulls are left out."""
    out: DataFrame | None = None
    for name, df, id_col, columns in tables:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
        part = df.select(F.lit(name).alias("tbl"), F.col(id_col).cast("bigint").alias("id"), pairs.alias("x")).select("tbl", "id", "x.field", "x.value").where("value is not null and value <> ''")
        out = part if out is None else out.unionByName(part)
    return out
