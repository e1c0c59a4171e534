"""Leaf blocks of pages, held as flat Arrow arrays and numpy columns so that whole batches are worked on at once.

A page is cut into lines, lines into blocks at sentence ends and around menu entries. A page that comes as HTML is first
turned into lines, with the ancestor tags of each text leaf kept as a mark in front of it.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .furniture import NAV_ANY
from .mojibake import plain_utf8

_MARK, _ENTRY_MARK = "\x1f", "\x1e"
_SENTENCE_END = r'([.!?…][.!?…"”»’)\]“]*)\s+(["“„«¿¡(\[]*[\p{Lu}\p{Lo}\d©→☎])'
#: Prompts as wholes (their patterns begin them only), after which a new block starts.
_PROMPTS = "|".join(
    (
        "Share this(?: on social media| article| page| post)?|Follow us on social media|Get our app for phones and tablets|Skip to (?:main )?content|Most read(?: this week| today)?|Tags in this section|Print this page",
        "Subscribe to our newsletter|Sign in to comment|Related (?:articles|posts|stories)|You (?:may|might) also like|Advertisement|Anzeige|Publicité|Publicidad|Pubblicità|Publicidade|Advertentie|Реклама|Meistgelesen",
        "Ähnliche (?:Artikel|Beiträge)|Artikel teilen|Newsletter abonnieren|Articles similaires|Les plus lus|Partager cet article|S'abonner à la newsletter|Artículos relacionados|Lo más leído|Compartir este artículo",
        "Suscríbase al boletín|Articoli correlati|I più letti|Condividi questo articolo|Iscriviti alla newsletter|Artigos relacionados|Mais lidas|Partilhar este artigo|Subscrever a newsletter|Gerelateerde artikelen",
        "Meest gelezen|Deel dit artikel|Abonneer op de nieuwsbrief|Похожие статьи|Самое читаемое|Поделиться статьёй|Подписаться на рассылку|(?:Leave a comment|Kommentare|Commentaires|Comentarios|Commenti|Comentários|Reacties|Комментарии) \\(\\d+\\)|OK",
    )
)
_ENTRY = rf"(^|[\s|·•»›>/–-])({NAV_ANY}|{_PROMPTS})(\s+[\p{{Lu}}|·•»›>/–—-]|$)"
#: The last entry of a menu may stand before anything.
_LAST_ENTRY = rf"({_ENTRY_MARK}[\s|·•»›>/–-]*)({NAV_ANY})\s+"
_AFTER_PAREN = r"(\(\d+\)|Learn more OK|Read more)\s+([\p{Lu}])"
_RIGHTS = r"\s(©|\(c\) |Copyright (?:©|\(c\)|19|20))"
#: Leads of UTF-8 read in a one-byte encoding, with what can follow.
_GARBLED = "[ÃÂÐÑâ][\u0080-\u00bf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|[РС][°±µ»‚‹¦©«¬®†‡€‰ѓЃ“”‘’Џђ]|√[©®°±≤¥µ∂∑∏π∫ªºΩæø¿]|[├╨╤][^ ]"
TAGS = ("nav", "header", "footer", "aside", "main", "article", "p", "li", "a", "h1", "h2", "td", "form", "button")
_SKIP = {"script", "style", "noscript", "template"}


class _Leaves(HTMLParser):
    """Text leaves with their ancestor tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.lines: list[tuple[str, tuple[str, ...]]] = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("br", "img", "input", "meta", "link", "hr"):
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        text = " ".join(data.split())
        if text and not _SKIP & set(self.stack):
            self.lines.append((text, tuple(t for t in self.stack if t in TAGS)))


def html_lines(page: str) -> tuple[str, list[tuple[str, ...]]]:
    """The lines of an HTML page, joined by newlines, and the ancestor tags of each."""
    p = _Leaves()
    p.feed(page)
    p.close()
    return "\n".join(t for t, _ in p.lines), [a for _, a in p.lines]


_LOOKS_HTML = re.compile(r"<(?:html|body|div|nav|p|ul|table|header|main|article)\b[^>]*>", re.I)


_GARBLED_RE = re.compile(_GARBLED)


def readable(text: str) -> str:
    """The text with any misread UTF-8 sequences decoded, for judging what it says."""
    return plain_utf8(text) if _GARBLED_RE.search(text) else text


def _counts(lists: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """By code point: 1 for letters, 2 for numbers, 4 for ASCII blanks, 8 for capitals; letters beyond the third plane."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x30000):
        kind = unicodedata.category(chr(c))
        table[c] = (1 if kind[0] == "L" else 2 if kind[0] == "N" else 0) | (8 if kind == "Lu" else 0)
    table[0x30000:0xE0000] = 1
    table[[9, 10, 12, 13, 32]] |= 4
    return table


def class_counts(text: pa.Array) -> dict[str, np.ndarray]:
    """Letters, numbers, blanks and capitals of each string, from one look at every character."""
    sizes = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _class_table()[codes]
    ends = np.cumsum(sizes)
    out = {}
    for name, bit in (("letters", 1), ("numbers", 2), ("blanks", 4), ("capitals", 8)):
        total = np.concatenate([[0], np.cumsum((kinds & bit) != 0, dtype=np.int64)])
        out[name] = total[ends] - total[ends - sizes]
    return out


def _apart(page: str, title: str | None) -> str:
    """The page with its own title, where a page of one line repeats it, as a block."""
    title = title.strip() if title else ""
    if len(title) < 12 or "\n" in page or title not in page:
        return page
    return page.replace(f" {title} ", f" {_MARK}{title}{_MARK} ") if f" {title} " in page else page.replace(f"{title} ", f"{title}{_MARK} ", 1) if page.startswith(f"{title} ") else page


class Blocks:
    """Blocks of a batch of pages: ``text`` (Arrow strings), ``doc`` and ``line`` (numpy), in page order."""

    def __init__(self, pages: pa.Array, titles: pa.Array | None = None, html: bool = True):
        pages = pc.fill_null(pages.cast(pa.string()), "")
        garbled = np.flatnonzero(pc.match_substring_regex(pages, _GARBLED).to_numpy(zero_copy_only=False))
        if len(garbled):  # judged by what they say
            mended = pages.to_pylist()
            for d in garbled.tolist():
                mended[d] = plain_utf8(mended[d])
            pages = pa.array(mended, pa.string())
        pages = pc.replace_substring_regex(pages, r"[\x1e\x1f\r\v\f]", " ")
        if titles is not None:
            pages = pa.array([_apart(p, t) for p, t in zip(pages.to_pylist(), titles.cast(pa.string()).to_pylist())], pa.string())
        self.n_docs = len(pages)
        tags: dict[tuple[int, int], tuple[str, ...]] = {}
        if html and pc.any(pc.match_substring(pages, "</")).as_py():
            plain = pages.to_pylist()
            for d in np.flatnonzero(pc.match_substring(pages, "</").to_numpy(zero_copy_only=False)):
                if _LOOKS_HTML.search(plain[d]):
                    plain[d], marks = html_lines(plain[d])
                    tags.update({(int(d), k): t for k, t in enumerate(marks)})
            pages = pa.array(plain, pa.string())
        lines = pc.split_pattern(pages, "\n")
        per_doc = _counts(lines)
        flat = lines.flatten()
        line_doc = np.repeat(np.arange(len(pages)), per_doc)
        line_no = np.arange(len(flat)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        self.n_lines = per_doc
        flat = pc.replace_substring_regex(flat, _SENTENCE_END, "\\1" + _MARK + "\\2")
        flat = pc.replace_substring_regex(flat, _RIGHTS, _MARK + "\\1")
        flat = pc.replace_substring_regex(flat, _AFTER_PAREN, "\\1" + _MARK + "\\2")
        for _ in range(2):  # neighbours share the blank between them
            flat = pc.replace_substring_regex(flat, _ENTRY, "\\1" + _ENTRY_MARK + "\\2" + _ENTRY_MARK + "\\3")
        flat = pc.replace_substring_regex(flat, _LAST_ENTRY, "\\1\\2" + _MARK)
        flat = pc.replace_substring(flat, _ENTRY_MARK, _MARK)
        parts = pc.split_pattern(flat, _MARK)
        per_line = _counts(parts)
        text = pc.utf8_trim_whitespace(parts.flatten())
        line_at = np.repeat(np.arange(len(flat)), per_line)
        keep = pc.not_equal(text, "")
        at = np.flatnonzero(keep.to_numpy(zero_copy_only=False))
        self.text = text.take(pa.array(at))
        self.doc, self.line = line_doc[line_at[at]], line_no[line_at[at]]
        self.tags = [tags.get((int(d), int(k)), ()) for d, k in zip(self.doc, self.line)] if tags else None

    def __len__(self) -> int:
        return len(self.text)

    def has(self, pattern: str, text: pa.Array | None = None) -> np.ndarray:
        """Whether each block matches an RE2 pattern."""
        return pc.match_substring_regex(self.text if text is None else text, pattern).to_numpy(zero_copy_only=False)

    def count(self, pattern: str, text: pa.Array | None = None) -> np.ndarray:
        return pc.count_substring_regex(self.text if text is None else text, pattern).to_numpy(zero_copy_only=False).astype(np.int64)

    @property
    def chars(self) -> np.ndarray:
        return pc.utf8_length(self.text).to_numpy(zero_copy_only=False).astype(np.int64)

    def sum_by_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, values, self.n_docs)


class CommonWords:
    """Counts of common words, for all languages together or one by one."""

    def __init__(self, words: dict[str, list[str]]):
        self.words = {k: sorted(set(v)) for k, v in sorted(words.items())}
        self.languages = list(self.words)
        whole = sorted({w for v in self.words.values() for w in v if len(w) > 1 or w in "ayeoéèàиваяскоу"}, key=len, reverse=True)
        self.any = r"(?:^|[^\p{L}])(?:" + "|".join(map(re.escape, whole)) + r")(?:[^\p{L}]|$)" if whole else r"a^"

    def count(self, lowered_doubled: pa.Array) -> np.ndarray:
        """``lowered_doubled``: lower case with every blank doubled, as neighbours share one."""
        return pc.count_substring_regex(lowered_doubled, self.any).to_numpy(zero_copy_only=False).astype(np.int64)


def doubled(text: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.utf8_lower(text), " ", "  ")


def sentence_shape(b: Blocks, common: CommonWords) -> dict[str, np.ndarray]:
    """Numbers that tell sentences from entries, rows and junk, per block."""
    low = doubled(b.text)
    chars = np.maximum(b.chars, 1)
    words = b.count(r"\p{L}[\p{L}\p{M}'’-]*")
    kinds = class_counts(b.text)
    letters = kinds["letters"]
    frequent = common.count(low)
    ended = b.has(r'[.!?…]["”»’)\]“]*$')
    upper = b.has(r'^["“„«¿¡(\[]*[\p{Lu}\d]')
    lettered = letters / np.maximum(1, chars - kinds["blanks"])
    often = frequent / np.maximum(1, words)
    code = b.has(r"[;{}]\s*$|\w\(.*\);|[=+~|#*%@_]{2,}|0x[0-9a-f]{4}")
    shouting = kinds["capitals"] > 0.6 * letters
    # only a page's last sentence may have been cut off
    last = np.r_[b.doc[1:] != b.doc[:-1], True] if len(b) else np.zeros(0, bool)
    plain = (words >= 4) & (lettered > 0.6) & ~code
    sentence = plain & ((ended & ((words >= 5) | (upper & (frequent >= 1)))) | (ended & (often > 0.2)) | (last & upper & (words >= 8) & (often >= 0.2)))
    return {"chars": chars, "words": words, "letters": letters, "frequent": frequent, "ended": ended, "upper": upper, "lettered": lettered, "often": often, "code": code, "shouting": shouting, "sentence": sentence}
