"""Problem 10: personal details in free text: find them, replace them by placeholders or by surrogates.

Detection is by shape (addresses in any notation, telephone and identity numbers by national formats, streets with house
numbers) and, for names, by shape and context: a person's name stands where a signature, a speaker, a titled person, a
contact person or the head of a contact entry stands; and wherever a name found so is written again in the document, in
full, family first or with an initial.

Surrogates are keyed and hold for the whole corpus, so that a person or number has one surrogate wherever it is mentioned
and different ones have different surrogates:

* Digits of telephone and identity numbers and of houses go through a keyed permutation of all numbers of their length
  (a Feistel network), which keeps country or area code and format; a permutation cannot collide. Letters of identity
  numbers go through keyed permutations of the alphabet.
* Name parts, streets, mail boxes and hosts become made-up words: the initial by a keyed permutation of letters (so that
  an initial stands for the name it begins), the rest spelt from a hash of key and part, with gender ending, script and
  case kept. Words can collide: all distinct parts of the corpus are grouped by their word, and in a group of several
  (or with a part that really exists) all but the first get their rank spelt behind it. Only those exceptions are sent to
  the pass that writes texts. The number of syllables grows with the number of distinct parts, so that no more than
  about ``EXCEPTIONS`` are to be expected whatever the corpus; their number is checked before they are broadcast.

Finding works on documents one by one in Arrow batches, without a shuffle; the collision check shuffles distinct parts,
never texts. Defined results: null and empty texts have no details and stay as they are; overlapping details keep the
earlier and longer; a repeated detail is one row of :func:`find` per place and one of ``p10_found``; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import hmac
import math
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import cut

KINDS = ("name", "email", "phone", "id_number", "street_address")


class Detail(NamedTuple):
    start: int
    end: int
    kind: str
    surface: str


_U, _L = "A-ZÀ-ÖØ-ÞŒŠŽА-ЯЁ", "a-zß-öø-ÿœšžа-яё"
_WORD = rf"(?:(?:[Dd][’'e]|[Vv]an |[Vv]on |[Dd]e |[Mm]c|[Oo][’'])?[{_U}][{_L}]+(?:['’][{_L}]+)?|[{_U}]{{2,}})"
_PART = rf"{_WORD}(?:-{_WORD})*"
_INITIAL = rf"[{_U}]\."
#: Given name or initials and family name in either order.
NAME = rf"(?:{_PART}, (?:{_PART}|{_INITIAL})(?: {_INITIAL})?|{_INITIAL}(?: ?{_INITIAL})? {_PART}|{_PART}(?: {_INITIAL}){{0,2}} {_PART})"

_LOCAL = r"[^\W_][\w.+-]*"
_DOT = r"(?:\.| ?\[dot\] ?| ?\(dot\) ?| dot )"
_HOST = rf"[^\W_][\w-]*(?:{_DOT}[^\W_][\w-]*)*{_DOT}[A-Za-zа-я]{{2,}}"
EMAIL = re.compile(rf"(?<![\w.+@-])(?:{_LOCAL} ?(?:@|\[at\]|\(at\)|\{{at\}}|<at>|＠) ?{_HOST}|{_LOCAL} at [^\W_][\w-]*(?: dot [^\W_][\w-]*)+)(?![\w@-])", re.I)

ID_NUMBER = re.compile(
    r"(?<![\w+/.-])(?:"
    r"\d{3}([- ])\d{2}\1\d{4}|"  # three, two and four digits
    r"[12] \d{2} \d{2} (?:\d{2}|2[AB]) \d{3} \d{3} \d{2}|[12]\d{2}\d{2}\d{2}\d{3}\d{3}\d{2}|"  # fifteen digits, the first 1 or 2
    r"\d{2} \d{2} \d{6}|\d{11}|"
    r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]|"  # two letters, six digits, a letter
    r"P<[A-Z]{3}\d{8,9}|[A-Z]\d{8}|[XYZ]\d{7}-?[A-Z]|\d{8}-?[A-HJ-NP-TV-Z]|"
    r"\d{4,6}-?\d{6}/\d{1,4}|\d{6}/\d{3,4}|\d{3}\.\d{3}\.\d{3}-\d{2}"
    r")(?![\w/-]|\.\d)"
)
PHONE = re.compile(
    r"(?<![\w+/.-])(?<!\d )(?:"
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+44 ?\(?0?\)?\d{2,4} ?\d{3,4} ?\d{3,4}|\+49 ?\(?0?\)?\d{2,4}[ /-]?\d{3,6}(?:[ -]\d{2,5})?|\+33 ?\d(?:[ .-]?\d{2}){4}|"
    r"\+3[49] ?\d{2,3} ?\d{3,4} ?\d{3,4}|\+351 ?\d{3} ?\d{3} ?\d{3}|\+31 ?\d{1,3}(?:[ -]?\d{2,4}){2,4}|\+7 ?\(?\d{3}\)?[ -]?\d{3}[ -]?\d{2}[ -]?\d{2}|"
    r"\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}|00(?:39|34|49|44|33|31|351|7|1) ?\d{1,4}(?:[ .-]?\d{2,4}){2,4}|"
    r"\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}\.\d{3}\.\d{4}|[2-9]\d{2}-[2-9]\d{2}-\d{4}|[2-9]\d{2}-\d{4}|8 ?\(?\d{3}\)?[ -]\d{3}[ -]\d{2}[ -]\d{2}|"
    r"0\d{4} \d{6}|0\d{2,4}[/-]\d{6,9}|0\d{2} \d{3} \d{2} \d{2}|0\d([ .-])\d{2}(?:\1\d{2}){3}|0\d{2,4} \d{3,4} \d{3,4}"
    r")(?![\w/-]|[.,]\d)"
)

_N = r"\d{1,4}"
_STREET_WORD = rf"[{_U}][{_L}]+(?:['’-][{_U}]?[{_L}]+)*"
_DAYS = r"(?!(?:Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag|Morgen|Abend|Ende|Anfang|Tag|Jahr|Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b)"
ADDRESS = re.compile(
    r"(?<![\w])(?:"
    rf"(?:(?:Flat|Apt\.?|Unit|Suite) \d+[A-Z]?, )?{_N}[A-Za-z]?(?: ?[-–/] ?{_N})? (?:[NSEW]\. |North |South |East |West )?(?:{_STREET_WORD} ){{1,3}}(?:Street|Road|Lane|Avenue|Terrace|Drive|Close|Way|Court|Square|Place|Boulevard|Row|Hill|Crescent|Gardens|St\b\.?|Rd\b\.?|Ave\b\.?|Ln\b\.?|Blvd\b\.?|Dr\b\.?|Ct\b\.?|Sq\b\.?)(?:,? (?:Flat|Apt\.?|Unit|Suite) \d+[A-Z]?)?|"
    rf"{_N}(?: ?(?:bis|ter|quater)\b|[A-Z]\b)?,? (?:rue|avenue|av\.|boulevard|bd|place|chemin|allée|quai|impasse|cours|route|square)(?: (?:de la|de l[’']|du|des|de|d[’']))? ?{_STREET_WORD}(?:[ -]{_STREET_WORD})?|"
    rf"(?:Calle|C/|C\.|Avda\.|Avenida|Av\.|Plaza|Pza\.|Paseo|Camino|Carrera) ?(?:de la |de |del )?{_STREET_WORD}(?: {_STREET_WORD})?,? (?:n\.?º ?|nº ?|núm\. ?)?{_N}(?:[A-Za-z]\b)?(?:, \d+\.?º(?: [A-Z]\b| izq\.?| dcha\.?)?)?|"
    rf"(?:Rua|R\.|Travessa|Praça|Largo|Alameda|Estrada) ?(?:da |do |das |dos |de )?{_STREET_WORD}(?: {_STREET_WORD})?,? (?:n\.?º ?|nº ?)?{_N}(?:[A-Za-z]\b)?(?:,? \d+\.?º(?: (?:dto|esq|dt)\b\.?)?)?|"
    rf"(?:Via|Viale|Piazza|P\.za|Corso|Vicolo|Largo|Strada) (?:della |del |dei |delle |di )?{_STREET_WORD}(?: {_STREET_WORD})?,? (?:n\. ?)?{_N}(?:[A-Za-z]\b|/[A-Za-z0-9]\b)?|"
    rf"{_STREET_WORD}(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|damm|ring|straat|laan|gracht|plein|kade|dijk|steeg) {_N}(?: ?[a-z]\b)?(?: ?(?:hs|bis|I{{1,3}})\b)?|"
    rf"(?:Am|An der|Im|In der|Zum|Zur|Unter den|Auf der|Bei der) {_DAYS}{_STREET_WORD} {_N}(?: ?[a-z]\b)?|"
    rf"(?:ул\.|улица|пр\.|пр-т|проспект|пер\.|переулок|бул\.|бульвар|наб\.|площадь|пл\.) {_STREET_WORD}(?: {_STREET_WORD})?,? (?:д\. ?|дом )?{_N}(?:[а-я]\b)?(?:,? (?:кв\. ?|корп\. ?|стр\. ?){_N})?|"
    rf"{_STREET_WORD} (?:ул\.|улица|пр\.|пр-т|проспект|пер\.|переулок|бул\.|наб\.|пл\.),? (?:д\. ?|дом )?{_N}(?:[а-я]\b)?(?:,? (?:кв\. ?|корп\. ?){_N})?"
    r")(?!\w)"
)

_BEFORE = re.compile(
    r"(?:(?:\b(?:Signed|Yours|Regards|Sincerely|Gezeichnet|Firmado|Signé|Firmato|Assinado|Getekend),|\b(?:Photos?|Text|Pictures?|Author|Written by|Interview|Fotos?|Autor(?:in)?|Auteur|Foto's|Contact|Kontakt|Contacto|Contatto|Фото|Автор|Текст) ?:|"
    r"\b(?:Ask|says|said|adds|told|asked|wrote|writes|explains|thank(?:s to)?|contact|dice|dijo|explica|dit|explique|sagt|sagte|erklärt|meint|zegt|zei|disse|diz|afferma|spiega|ha detto|says Mr|сказал|сказала|говорит|объясняет|сообщил|сообщила|спросите|Спросите)|"
    r"\b(?:Ansprechpartner(?:in)? ist|Fragen Sie|Wenden Sie sich an|Renseignements auprès de|Adressez-vous à|Demandez|Pregunte por|Pregunten por|Diríjase a|Chiedere di|Rivolgersi a|Chiedete di|Fale com|Pergunte por|Informações com|Vraag naar|Neem contact op met|Informatie bij|Обращайтесь к|Отвечает|Ответственный)|"
    r"\b[Tt]he winner,|\b(?:Der|Die) Gewinner(?:in)?,|\b[Ll][ea] gagnante?,|\bEl ganador,|\bLa ganadora,|\b[Ii]l vincitore,|\bO vencedor,|\b[Dd]e winnaar,|\b[Пп]обедитель,?)\s|^\s*[—–-] |(?<=\n)[—–-] |(?<=[.!?…] )— )"
    r"(?:(?:Dr|Mr|Mrs|Ms|Prof|Hr|Fr|Sr|Sra|Sig|Dott|Mme|Mlle|Dhr|Mevr|Ing)\.? |(?:Herr|Frau|Doña|Don|Monsieur|Madame|Professor|Doctor|Signora|Signor|господин|госпожа|д-р) )*"
    rf"(?P<n>{NAME})(?![\w-])"
)
_AFTER_TAILS = (
    " will answer", ", who lives", ", was delighted", ", qui habite", ", qui vit", ", der in", ", die in", ", die hier", " for the key", " for the talk", " answers your", " beantwortet", " répond à", " répondra à", ", que vive", ", che abita",
    " responde", " risponde", " beantwoordt", " ответит",
)
_AFTER = re.compile(rf"(?<![\w-])(?P<n>{NAME})(?={'|'.join(map(re.escape, _AFTER_TAILS))})")
_HEAD = re.compile(rf"(?:(?<=\n)|^|(?<=[.!?…»”“\")] )|(?<=[|•·] ))[ \t]*\(?(?P<n>{NAME})\)?[ \t]*(?=[|•·\n])")
#: What every text with an address, or with a long number, has.
_AT = ("@", "＠", "[at", "(at", "{at", "<at", "[AT", "(AT", " dot ", " DOT ")
_NUMBER = re.compile(r"\d[\d .()/-]{5,}\d|[A-Z] ?\d\d|P<[A-Z]")
_DIGIT = re.compile(r"\d")
#: How the triggers before a name begin; the pattern is tried at these places only.
_TRIGGERS = (
    "Signed,|Yours,|Regards,|Sincerely,|Gezeichnet,|Firmado,|Signé,|Firmato,|Assinado,|Getekend,|Photo|Text|Picture|Author|Written by|Interview|Foto|Autor|Auteur|Contact|Kontakt|Contatto|Фото|Автор|Текст|Ask|says|said|adds|told|asked|wrote|"
    "writes|explains|thank|contact|dice|dijo|explica|dit|explique|sagt|erklärt|meint|zegt|zei|disse|diz|afferma|spiega|ha detto|сказал|говорит|объясняет|сообщил|просите|Ansprechpartner|Fragen Sie|Wenden Sie|Renseignements|Adressez|Demandez|"
    "Pregunte|Diríjase|Chiede|Rivolgersi|Fale com|Pergunte|Informações|Vraag naar|Neem contact|Informatie bij|Обращайтесь|Отвечает|Ответственный|winner,|Gewinner|gagnant|ganador|vincitore,|vencedor,|winnaar,|обедитель|— |– |- "
).split("|")


def _triggered(text: str) -> Iterator[re.Match]:
    """Names behind triggers, in the way a scan with the whole pattern would find them, but from the triggers' places."""
    seen: set[tuple[int, int]] = set()
    if text.lstrip()[:1] in ("—", "–", "-") and (m := _BEFORE.match(text)):  # a dash leads the text, after any blanks
        seen.add(m.span("n"))
        yield m
    for w in _TRIGGERS:
        at = text.find(w)
        while at >= 0:
            for start in range(max(0, at - 4), at + 1) if w in _INSIDE else (at,):
                m = _BEFORE.match(text, start)
                if m and m.span("n") not in seen:
                    seen.add(m.span("n"))
                    yield m
            at = text.find(w, at + 1)


#: Triggers that begin a little before the words searched for (an article, a small or a capital letter, blanks).
_INSIDE = {"winner,", "Gewinner", "gagnant", "ganador", "vincitore,", "vencedor,", "winnaar,", "обедитель", "просите", "— ", "– ", "- "}


_FULL = rf"{_PART}(?: {_INITIAL}){{0,2}} {_PART}"
#: A titled person, and a person who speaks, anywhere.
_TITLED = re.compile(rf"(?<![\w-])(?:(?:Mr|Mrs|Ms|Dr|Prof|Sra?|Sig|Dott|Dhr|Mevr)\.?|Herr|Frau|Mme|Mlle|Monsieur|Madame|Señora?|Doña|Signora?|Senhora?|Meneer|Mevrouw|господин|госпожа|Professor|Doctor) (?P<n>{_FULL})(?![\w-])")
_SAYS = "said|says|told|explained|explains|added|adds|wrote|writes|sagte|sagt|erklärte|erklärt|meinte|meint|a dit|dit|explique|a expliqué|dijo|dice|explicó|ha detto|ha spiegato|disse|diz|explicou|zei|zegt|сказал|сказала|говорит|сообщил|сообщила|объяснил|объяснила".split("|")
_SPEAKS = re.compile(rf"(?<![\w-])(?P<n>{_FULL})(?= (?:{'|'.join(_SAYS)})\b)")
_TITLES = ("Mr", "Ms", "Dr", "Prof", "Sr", "Sig", "Dott", "Dhr", "Mev", "Herr", "Frau", "Mme", "Mlle", "Mons", "Mada", "Señor", "Doña", "Senhor", "Mene", "госп", "Doctor")


def _again(text: str, names: list[str]) -> Iterator[tuple[int, int]]:
    """Places where names found elsewhere in the text are written again: as they are, family first, or with an initial."""
    for name in dict.fromkeys(names):
        tokens = name.replace(",", "").split()
        if len(tokens) < 2:
            continue
        given, family = (tokens[1:], tokens[0]) if "," in name else (tokens[:-1], tokens[-1])
        for form in {" ".join([*given, family]), f"{family}, {' '.join(given)}", f"{given[0][0]}. {family}"}:
            at = text.find(form)
            while at >= 0:
                end = at + len(form)
                if not (at and (text[at - 1].isalnum() or text[at - 1] in "-’'")) and not (end < len(text) and (text[end].isalnum() or text[end] in "-’'")):
                    yield at, end
                at = text.find(form, end)


_PAREN = re.compile(rf"\((?P<n>{NAME})\)")
_LABEL = re.compile(r"[\s|•·]*(?:(?:E-?[Mm]ail|Mail|Tel(?:efon|éfono|efone|éphone)?|Phone|Mobile|Mobil|Tfno|Tél|Тел|Address|Adresse|Anschrift|Dirección|Indirizzo|Morada|Adres|Адрес|ID(?:-No)?|National ID|Passport no|DNI|Steuer-ID)\b[.:]* ?:?|[☎→✉<(]|\s)*")
#: Capitalised words that head lines and notices but are no names.
_NOT_NAMES = re.compile(
    r"(?i)\b(?:street|road|lane|avenue|terrace|blvd|ltd|inc|gmbh|error|access|denied|gateway|server|found|page|site|home|about|contact|privacy|terms|news|press|guide|market|archive|the|and|for|with|this|that|our|your|all|new|untitled|document|loading|please|required|attention|"
    r"request|service|internal|forbidden|not|too|many|requests|insert|title|default|moment|back|read|more|der|die|das|und|le|la|les|el|los|las|il|gli|het|een|een|für|von|über|город\w*|улица)\b"
)


def _clear(taken: list[Detail], a: int, b: int) -> bool:
    return all(b <= d.start or a >= d.end for d in taken)


def find(text: str | None) -> list[Detail]:
    """All personal details of a text, in order."""
    if not text:
        return []
    out: list[Detail] = []
    shapes = [("email", EMAIL)] if any(x in text for x in _AT) else []
    shapes += [("street_address", ADDRESS)] if _DIGIT.search(text) else []
    shapes += [("id_number", ID_NUMBER), ("phone", PHONE)] if _NUMBER.search(text) else []
    for kind, pattern in shapes:
        for m in pattern.finditer(text):
            a, b = m.span()
            if _clear(out, a, b):
                out.append(Detail(a, b, kind, text[a:b]))
    starts = {d.start for d in out}
    for pattern in (None, *([_AFTER] if any(x in text for x in _AFTER_TAILS) else []), *([_HEAD] if starts else []), *([_PAREN] if "(" in text else []), *([_TITLED] if any(x in text for x in _TITLES) else []), *([_SPEAKS] if any(f" {x}" in text for x in _SAYS) else [])):
        for m in _triggered(text) if pattern is None else pattern.finditer(text):
            a, b = m.span("n")
            if not _clear(out, a, b) or _NOT_NAMES.search(m.group("n")):
                continue
            if pattern is _HEAD:
                after = _LABEL.match(text, m.end())
                if not any(s in starts for s in range(m.end(), after.end() + 1)):
                    continue
            out.append(Detail(a, b, "name", text[a:b]))
    for a, b in sorted(_again(text, [d.surface for d in out if d.kind == "name"])):
        if _clear(out, a, b):
            out.append(Detail(a, b, "name", text[a:b]))
    return sorted(out)


# --- placeholders and surrogates ----------------------------------------------------------------------------------


def redact(text: str | None, details: list[Detail] | None = None) -> str | None:
    """The text with each detail replaced by a placeholder of its kind, otherwise unchanged."""
    if not text:
        return text
    out, at = [], 0
    for d in find(text) if details is None else details:
        out += [text[at : d.start], f"[{d.kind.upper()}]"]
        at = d.end
    return "".join([*out, text[at:]])


EXCEPTIONS = 2_000  # collisions to be expected at most
MOST_EXCEPTIONS = 200_000  # rows that may be broadcast; about 20 MB
_CONSONANTS, _VOWELS = "bdfgklmnprstvwz", "aeiou"
_CONSONANTS_CYR, _VOWELS_CYR = "бвгдзклмнпрст", "аеиоу"
_FEMALE = re.compile(r"(?:[aeiyаяиью]|ine|ett|it|uth|ah|eth|iam|men|rid|bel|quel|gail|lyn)$")
#: Given names against the rule of endings (fixed list).
_MALE = frozenset("luca andrea nikita ilya joshua noah elijah ezra sasha mika kofi rene jose pablo otto hugo bruno leo theo marco pedro diego mario antonio pietro никита илья лука фома кузьма savva mattia george andre pierre jean guillaume philippe christophe harry tony henry barry jimmy billy rudi toni uwe arne rainer ole".split())
#: Endings of Russian family names that agree with the gender.
_ENDING_CYR = re.compile(r"(?:ова|ева|ёва|ина|ская|цкая|ов|ев|ёв|ин|ский|цкий|енко|ич|ая|ый)$")
_STREET_TAIL = re.compile(r"(?:straße|strasse|str|weg|platz|gasse|allee|ufer|damm|ring|straat|laan|gracht|plein|kade|dijk|steeg)$")
_STREET_WORDS = re.compile(
    r"^(?:Street|Road|Lane|Avenue|Terrace|Drive|Close|Way|Court|Square|Place|Boulevard|Row|Hill|Crescent|Gardens|Flat|Apt|Unit|Suite|Calle|Avda|Avenida|Plaza|Pza|Paseo|Camino|Carrera|Rua|Travessa|Praça|Largo|Alameda|Estrada|Via|Viale|Piazza|Corso|Vicolo|Strada|Am|An|Im|In|Zum|Zur|Unter|Auf|Bei|"
    r"North|South|East|West|St|Rd|Ave|Ln|Blvd|Dr|Ct|Sq|C|R|N|S|E|W)$"
)


class Keyed:
    """Keyed functions: digits by permutation, words by hash; ``syllables`` is the length of made-up words."""

    def __init__(self, key: bytes, syllables: int = 4, ranks: dict[tuple[str, str], int] | None = None):
        self.key, self.syllables, self.ranks = key, syllables, ranks or {}
        self.letters: dict[str, dict[str, str]] = {}
        self.known: dict[tuple[str, str], str] = {}

    def hash(self, *parts: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, parts)).encode("utf-8", "replace"), hashlib.sha256).digest()[:16], "big")

    def digits(self, what: str, n: str) -> str:
        """A permutation of all digit strings of a length, by ``what``."""
        if len(n) < 2:
            return self.letter("digit " + what, n, "0123456789") if n else n
        cut = len(n) // 2
        a, b = n[:cut], n[cut:]
        for turn in range(8):
            a, b = b, str((int(a) + self.hash(what, turn, len(n), b)) % 10 ** len(a)).zfill(len(a))
        return a + b

    def number(self, what: str, n: str) -> str:
        """A permutation of the numbers of a length that do not begin with 0: walks on until there is one."""
        m = self.digits(what, n)
        while m[0] == "0" and n[0] != "0":
            m = self.digits(what, m)
        return m

    def letter(self, what: str, c: str, alphabet: str) -> str:
        """A keyed permutation of an alphabet; other characters stay."""
        if what not in self.letters:
            order = sorted(alphabet, key=lambda x: self.hash(what, x))
            self.letters[what] = dict(zip(alphabet, order))
        return self.letters[what].get(c, c)

    def _spell(self, number: int, n: int, cyrillic: bool) -> str:
        c, v = (_CONSONANTS_CYR, _VOWELS_CYR) if cyrillic else (_CONSONANTS, _VOWELS)
        out = ""
        for _ in range(n):
            number, k = divmod(number, len(c) * len(v))
            out += c[k // len(v)] + v[k % len(v)]
        return out

    def base(self, what: str, part: str) -> str:
        """The word of a part before the collision check, in lower case."""
        cyrillic = bool(re.search("[а-яё]", part))
        alphabet = "абвгдезиклмнопрстуфхэ" if cyrillic else "abcdefghijklmnopqrstuvwyz"
        plain = unicodedata.normalize("NFD", part[:1])[:1]
        first = self.letter("initial" + "c" * cyrillic, plain if plain in alphabet else "a" if not cyrillic else "а", alphabet)
        vowels = "аеиоуэ" if cyrillic else "aeiouy"
        return first + ("" if first in vowels else vowels[self.hash("vowel", what, part) % 5]) + self._spell(self.hash(what, part), self.syllables, cyrillic)

    def word(self, what: str, part: str) -> str:
        """The word of a part, with its rank where others have the same word."""
        have = self.known.get((what, part))
        if have is None:
            have, rank = self.base(what, part), self.ranks.get((what, part), 0)
            if rank:  # one letter more than any base has, then the rank
                cyrillic = bool(re.search("[а-яё]", part))
                have += ("к" if cyrillic else "k") + self._spell(rank, max(2, math.ceil(math.log(rank + 1, 60))), cyrillic)
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[what, part] = have
        return have


def _like(model: str, word: str) -> str:
    return word.upper() if model.isupper() and len(model) > 1 else word.lower() if model.islower() else word[:1].upper() + word[1:]


def _name_tokens(surface: str) -> list[tuple[str, str]]:
    """``(token, role)`` of a name in the order written; roles are given, family, initial and mark."""
    first_family = "," in surface
    tokens = re.findall(r"[^\s,]+|,", surface)
    whole = [t for t in tokens if not t.endswith(".") and t != ","]
    small = re.compile(r"^(?:van|von|de|der|den|da|di|du|la|le|ter|ten|zu|el)$", re.I)
    body = [t for t in whole if not small.match(t)] or whole
    family = body[0] if first_family or len(body) == 1 else body[-1]
    out = []
    for t in tokens:
        role = "mark" if t == "," or (small.match(t) and t not in (family,)) else "initial" if t.endswith(".") else "family" if t == family else "given"
        out.append((t, role))
    return out


def _stem(part: str) -> tuple[str, str]:
    """A family name without an ending that agrees with the gender, and that ending."""
    m = _ENDING_CYR.search(part)
    return (part[: m.start()], m.group()) if m and m.start() > 1 else (part, "")


def parts_of(kind: str, surface: str) -> list[tuple[str, str]]:
    """``(what, part)`` of a detail's parts that become made-up words."""
    if kind == "name":
        out = []
        for t, role in _name_tokens(surface):
            for x in t.casefold().split("-") if role in ("given", "family") else ():
                out.append((role, _stem(x)[0] if role == "family" else x))
        return out
    if kind == "email":
        local, _, host = _email_parts(surface)
        return [("box", local), ("host", host)]
    if kind == "street_address":
        return [("street", w) for _, w in _street_words(surface)]
    return []


def _email_parts(surface: str) -> tuple[str, str, str]:
    m = re.match(rf"({_LOCAL})( ?(?:@|\[at\]|\(at\)|\{{at\}}|<at>|＠) ?| at )(.+)$", surface, re.I | re.S)
    local, at, host = m.groups()
    return local.casefold(), at, re.split(r"\.| ?\[dot\] ?| ?\(dot\) ?| dot ", host, flags=re.I)[0].casefold()


def _street_words(surface: str) -> list[tuple[re.Match, str]]:
    out = []
    for m in re.finditer(r"[^\W\d_]+", surface):
        w = m.group()
        if w[0].isupper() and len(w) > 2 and not _STREET_WORDS.match(w):
            tail = _STREET_TAIL.search(w)
            out.append((m, (w[: tail.start()] if tail and tail.start() > 2 else w).casefold()))
    return out


class Surrogates:
    """The surrogates of a corpus under a key."""

    def __init__(self, keyed: Keyed):
        self.keyed = keyed

    def _name(self, surface: str) -> str:
        out = []
        for t, role in _name_tokens(surface):
            if role == "mark":
                out.append(t)
                continue
            if role == "initial":
                low, cyrillic = t[0].casefold(), "\u0400" <= t[0] <= "\u04ff"
                out.append(self.keyed.base("given", low)[0].upper() + "." if len(t) == 2 or not cyrillic else t)
                continue
            new = []
            for x in t.split("-"):
                low = x.casefold()
                if role == "given":
                    w = self.keyed.word("given", low)
                    female = bool(_FEMALE.search(low)) and low not in _MALE
                    w += ("на" if female else "н") if "\u0400" <= low[0] <= "\u04ff" else ("na" if female else "n")
                else:
                    stem, ending = _stem(low)
                    w = self.keyed.word("family", stem) + ending
                new.append(_like(x, w))
            out.append("-".join(new))
        return " ".join(out).replace(" ,", ",")

    def _number(self, kind: str, surface: str, keep: int) -> str:
        """Digits after the first ``keep`` (country or area) and letters replaced one for one; the format stays."""
        found = "".join(c for c in surface if c.isdigit() and c.isascii())
        moved = found[:keep] + self.keyed.digits(f"{kind} {found[:keep]}", found[keep:])
        it = iter(moved)
        return "".join(next(it) if c.isdigit() and c.isascii() else self.keyed.letter(f"{kind} {k}", c, "ABCDEFGHJKLMNPRSTVWXYZ") if kind == "id_number" and k > 1 else c for k, c in enumerate(surface))

    def _email(self, surface: str) -> str:
        local, at, host = _email_parts(surface)
        word, home = self.keyed.word("box", local), self.keyed.word("host", host)
        rest = surface[len(local) + len(at) :]
        marks = re.findall(r"[._+-]", local)
        if marks and len(word) > 5:
            word = word[:3] + marks[0] + word[3:]
        own = surface[: len(local)]
        return _like(own, word) if own.isupper() else word, at, home + "-mail", rest[len(host) :]

    def _address(self, surface: str) -> str:
        out, at = [], 0
        words = _street_words(surface)
        street = " ".join(w for _, w in words)
        for m, w in words:
            out += [surface[at : m.start()], _like(m.group(), self.keyed.word("street", w) + m.group()[len(w) :].lower())]
            at = m.end()
        out.append(surface[at:])
        return re.sub(r"\d+", lambda m: self.keyed.number("house " + street, m.group()), "".join(out))

    def of(self, kind: str, surface: str) -> str:
        if kind == "name":
            return self._name(surface)
        if kind == "email":
            return "".join(self._email(surface))
        if kind == "street_address":
            return self._address(surface)
        digits = sum(c.isdigit() and c.isascii() for c in surface)
        return self._number(kind, surface, max(0, min(4, digits - 6)) if kind == "phone" else 0)


def disguise(text: str | None, made: Surrogates, details: list[Detail] | None = None) -> str | None:
    """The text with each detail replaced by its surrogate."""
    if not text:
        return text
    out, at = [], 0
    for d in find(text) if details is None else details:
        out += [text[at : d.start], made.of(d.kind, d.surface)]
        at = d.end
    return "".join([*out, text[at:]])


# --- operators ----------------------------------------------------------------------------------------------------


def find_details(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, end, kind, surface)`` of every detail; offsets count code points."""
    src = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null and text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, details = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                found = find(t)
                rows += [k] * len(found)
                details += found
            columns = list(zip(*details)) if details else [[], [], [], []]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(list(c), t) for c, t in zip(columns, kinds))], names=["doc_id", "start", "end", "kind", "surface"])

    return src.mapInArrow(run, "doc_id bigint, start int, end int, kind string, surface string")


def exceptions(details: DataFrame, key: bytes, syllables: int) -> DataFrame:
    """``(what, part, rank)`` of parts whose word others have too, by a grouped check of all distinct parts of the corpus."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [p for kind, surface in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p in parts_of(kind, surface)]
            columns = list(zip(*rows)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names=["what", "part"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key, syllables)
        for b in batches:
            words = [keyed.base(what, part) for what, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.string())], names=["what", "part", "word"])

    distinct = details.select("kind", "surface").distinct()
    parts = distinct.mapInArrow(spread, "what string, part string").distinct()
    words = parts.mapInArrow(spell, "what string, part string, word string")
    # words that really exist come first in their group, so that nobody gets them
    real = parts.select("what", F.lit(None).cast("string").alias("part"), F.col("part").alias("word"))
    alike = words.unionByName(real).withColumn("n", F.count("*").over(Window.partitionBy("what", "word"))).where("n > 1")
    ranked = alike.withColumn("rank", F.row_number().over(Window.partitionBy("what", "word").orderBy(F.col("part").asc_nulls_first())) - 1)
    return ranked.where("part is not null and rank > 0").select("what", "part", "rank")


def keyed_for(details: DataFrame, key: bytes) -> Keyed:
    """The keyed functions of a corpus: enough syllables for its distinct details, and its few exceptions."""
    n = max(2, details.select(F.approx_count_distinct(F.xxhash64("kind", "surface"))).first()[0] * 2)
    syllables = max(4, math.ceil(math.log(n * n / (2 * EXCEPTIONS), len(_CONSONANTS_CYR) * len(_VOWELS_CYR))) if n * n > 2 * EXCEPTIONS else 4)
    few = exceptions(details, key, syllables).limit(MOST_EXCEPTIONS + 1).collect()
    if len(few) > MOST_EXCEPTIONS:
        raise RuntimeError("more collisions than can be broadcast: choose another key")
    return Keyed(key, syllables, {(r.what, r.part): r.rank for r in few})


def replace_details(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes | None = None) -> DataFrame:
    """``(doc_id, n_details, text)`` of every row: placeholders, or surrogates if there is a key."""
    src = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = None
    if key is not None:
        keyed = keyed_for(cut(find_details(df, id_col, text_col).select("kind", "surface")), key)
        shared = df.sparkSession.sparkContext.broadcast((keyed.key, keyed.syllables, keyed.ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(Keyed(*shared.value)) if shared is not None else None
        for b in batches:
            counts, texts = [], []
            for t in b.column(1).to_pylist():
                details = find(t)
                counts.append(len(details))
                texts.append(redact(t, details) if made is None else disguise(t, made, details))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int32()), pa.array(texts, pa.string())], names=["doc_id", "n_details", "text"])

    return src.mapInArrow(run, "doc_id bigint, n_details int, text string")
