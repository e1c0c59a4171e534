"""Problem 3: keep the main body of a page by a linear-chain conditional random field over its leaf blocks.

States are body (0) and furniture (1). A block's features come from its text, its place, its neighbours and, for HTML
input, its ancestor tags. The weights are fitted by gradient ascent on the conditional log likelihood of labelled pages;
decoding is Viterbi, over all pages of a batch at once. Labelled pages are composed on the driver, with a fixed seed,
from the clean sentences of ``lang_samples`` (a table of bounded size) and the vocabulary of :mod:`furniture`: menus,
breadcrumbs, notices, side columns and footers around paragraphs, headings, lists, tables and code; a quarter of them as
HTML. In half of them the lists of phrases say nothing, so that furniture of other words is told by shape, place and
neighbours.

Work is done page by page within Arrow batches: no shuffle, and only the model (about 80 numbers) is broadcast.

Defined results: null and empty pages have an empty body and no furniture; a page of one line is one line, of which
furniture blocks are cut out; repeated rows are kept; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import inspect
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, CommonWords, sentence_shape
from .furniture import COOKIE, FOOTER, HEADING, NAV, NAV_ANY, PROMPT_ANY, SEPARATOR

TRAIN_PAGES = 900
ROUNDS = 260
HIDDEN = 0.5  # share of training pages whose furniture is on no list
NEAR = 4  # blocks on either side that neighbour features look at
_SLAB = 4000  # pages worked on at a time

FEATURES = (
    "bias", "entry", "separator", "led by separator", "trailed by separator", "prompt", "heading", "cookie", "footer", "ended", "one word",
    "few words", "some words", "many words", "sentence", "title-like", "short question", "first", "last", "early", "late", "after entry", "before entry",
    "near entries", "after heading", "in side list", "own title", "many separators", "digits", "code", "bulleted", "row-like", "boxed tag", "body tag", "after cookie", "after ad or prompt",
    "long without end", "no common word", "last after sentence", "very long without end", "only block", "long without common word", "long in signs", "page of equal starts", "title-like without sentences",
    "menu-shaped", "in a short run", "after menu-shaped",
)


_ITEM = r"\p{Lu}[\p{L}'’-]*(?: [\p{L}'’-]+){0,3}"
#: Short capitalised items between separators or wide gaps, whatever they say.
_MENU_SHAPED = rf"^{_ITEM}(?:(?:\s*[|·•»›>/]\s*|\s+[–—-]\s+|\s{{2,}}){_ITEM}){{2,}}$"


def _shift(x: np.ndarray, doc: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` blocks back (or ahead if negative) in the same page, else False."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by] & (doc[by:] == doc[:-by])
    elif by < 0:
        out[:by] = x[-by:] & (doc[:by] == doc[-by:])
    return out


def features(b: Blocks, common: CommonWords, titles: pa.Array | None, shape: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The binary feature matrix of all blocks, and their sentence shape."""
    n = len(b)
    s = shape or sentence_shape(b, common)
    doc, words = b.doc, s["words"]
    entry = b.has(rf"^(?:{NAV_ANY})$")
    separator = b.has(rf"^{SEPARATOR}$")
    led, trailed = b.has(rf"^{SEPARATOR}\s"), b.has(rf"\s{SEPARATOR}$")
    prompt = b.has(rf"^(?:{PROMPT_ANY})")
    prompt &= (words <= 9) & ~(s["ended"] & s["sentence"])
    heading = b.has(rf"^(?:{HEADING})") & (words <= 6)
    cookie, footer = b.has(COOKIE), b.has(FOOTER)
    question = b.has(r"\?$") & (words <= 7)
    title_like = ~s["ended"] & s["upper"] & (words >= 2) & (words <= 14) & (s["lettered"] > 0.8) & ~s["code"]
    title_like |= question
    many_sep = b.count(r"\s[|·•»›>/]\s") >= 2
    first = np.r_[True, doc[1:] != doc[:-1]] if n else np.zeros(0, bool)
    last = np.r_[doc[1:] != doc[:-1], True] if n else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, int)
    place = np.arange(n) - start
    size = np.bincount(doc, minlength=b.n_docs)[doc] if n else place
    menu = entry | separator
    near = np.zeros(n, dtype=np.int64)
    for k in range(1, NEAR + 1):
        near += _shift(menu, doc, k).astype(np.int64) + _shift(menu, doc, -k)
    # a side list runs from a heading or prompt over title-like blocks; it ends at any other
    idx = np.arange(n)
    broken = np.maximum.accumulate(np.where(first | (~title_like & ~heading & ~prompt), idx, -1)) if n else idx
    headed = np.maximum.accumulate(np.where(heading | prompt, idx, -1)) if n else idx
    side = title_like & (headed >= 0) & (headed > broken) & (headed >= start) if n else np.zeros(0, bool)
    own = np.zeros(n, dtype=bool)
    if titles is not None and n:
        page = pc.utf8_trim_whitespace(pc.fill_null(titles.cast(pa.string()), "")).take(pa.array(doc))
        own = pc.equal(b.text, page).to_numpy(zero_copy_only=False) & (words > 0)
    letters_few = s["lettered"] < 0.5
    bulleted = b.has(r"^(?:[*•–-]|\d+[.)])\s")
    numbers = b.count(r"(?:^|\s)\S*\d\S*")
    row = (numbers >= 2) & (numbers * 3 >= np.maximum(1, words))
    boxed, body = np.zeros(n, bool), np.zeros(n, bool)
    if b.tags is not None:
        boxed = np.fromiter((bool({"nav", "header", "footer", "aside", "form", "button"} & set(t)) for t in b.tags), bool, n)
        body = np.fromiter((bool({"article", "main", "p"} & set(t)) for t in b.tags), bool, n) & ~boxed
    # pages of rows that mostly start alike, and title-like rows of pages without any sentence
    start_word = pc.list_element(pc.utf8_split_whitespace(b.text, max_splits=1), 0).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if n else np.zeros(0, np.int64)
    pairs, times = np.unique(doc.astype(np.int64) * (n + 1) + start_word, return_counts=True)
    most = np.zeros(b.n_docs, dtype=np.int64)
    np.maximum.at(most, pairs // (n + 1), times)
    alike = (most[doc] >= 5) & (most[doc] * 2 >= size)
    prose = b.sum_by_doc(s["sentence"] & ~cookie & ~footer)[doc] > 0
    shaped = b.has(_MENU_SHAPED)
    short = (words >= 1) & (words <= 3) & ~s["ended"] & s["upper"] & (s["lettered"] > 0.9) & ~s["code"]
    run = short & (sum(_shift(short, doc, k).astype(np.int64) for k in (-2, -1, 1, 2)) >= 2)
    columns = [
        np.ones(n, bool), entry, separator, led, trailed, prompt, heading, cookie, footer, s["ended"], words <= 1, (words >= 2) & (words <= 3), (words >= 4) & (words <= 9),
        words >= 10, s["sentence"], title_like, question, first, last, place < 3, size - place <= 3, _shift(menu, doc, 1), _shift(menu, doc, -1), near >= 3, _shift(heading, doc, 1), side, own, many_sep,
        letters_few, s["code"], bulleted, row, boxed, body, _shift(cookie, doc, 1), _shift(prompt, doc, 1), (words >= 8) & ~s["ended"], s["frequent"] == 0,
        last & ~s["ended"] & _shift(s["sentence"], doc, 1) & ~entry & ~prompt & ~footer & (words >= 2), (s["chars"] >= 130) & ~s["ended"], first & last,
        (s["chars"] >= 90) & (s["frequent"] == 0) & ~cookie & ~footer, (s["chars"] >= 50) & letters_few & ~footer,
        alike & ~entry & ~prompt & ~cookie & ~footer, title_like & ~prose & ~entry, shaped, run, _shift(shaped, doc, 1),
    ]
    return np.column_stack(columns).astype(np.float32) if n else np.zeros((0, len(FEATURES)), np.float32), s


class Chain:
    """Weights of the chain: ``unary`` (features) for state 1 over state 0, ``pair[a, b]`` for a step from a to b."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def decode(self, x: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """The most probable state of each block, by Viterbi over all pages at once."""
        n = len(x)
        if n == 0:
            return np.zeros(0, dtype=np.int8)
        emit = x @ self.unary
        sizes = np.bincount(doc, minlength=n_docs)
        order = np.argsort(-sizes, kind="stable")
        begins = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        live = int((sizes > 0).sum())
        score = np.zeros((live, 2))
        score[:, 1] = emit[begins[:live]]
        back = np.zeros((n, 2), dtype=np.int8)
        ends = score.copy()
        for k in range(1, int(sizes[0])):
            live = int(np.searchsorted(-sizes, -k, side="left"))
            at = begins[:live] + k
            step = score[:live, :, None] + self.pair[None]
            best = step.argmax(axis=1).astype(np.int8)
            back[at] = best
            score = np.take_along_axis(step, best[:, None, :].astype(np.int64), axis=1)[:, 0]
            score[:, 1] += emit[at]
            ends[:live] = score
        states = np.zeros(n, dtype=np.int8)
        now = ends.argmax(axis=1).astype(np.int8)
        for k in range(int(sizes[0]) - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -k, side="left"))
            at = begins[:live] + k
            states[at] = now[:live]
            if k:
                now[:live] = back[at, now[:live]]
        return states


def fit(x: np.ndarray, doc: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = 0.15, l2: float = 1e-4) -> Chain:
    """Maximise the conditional log likelihood by Adam over exact forward-backward marginals."""
    sizes = np.bincount(doc)
    d, length = len(sizes), int(sizes.max())
    begins = np.cumsum(sizes) - sizes
    slot = begins[:, None] + np.arange(length)[None]
    mask = np.arange(length)[None] < sizes[:, None]
    slot = np.where(mask, slot, 0)
    unary, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)]
    pairs_seen = np.zeros((2, 2))
    same = doc[1:] == doc[:-1]
    np.add.at(pairs_seen, (y[:-1][same], y[1:][same]), 1)
    for t in range(1, rounds + 1):
        emit = np.zeros((d, length, 2))
        emit[..., 1] = (x @ unary)[slot]
        fw, bw = np.zeros((d, length, 2)), np.zeros((d, length, 2))
        fw[:, 0] = emit[:, 0]
        for k in range(1, length):
            step = np.logaddexp.reduce(fw[:, k - 1, :, None] + pair[None], axis=1) + emit[:, k]
            fw[:, k] = np.where(mask[:, k, None], step, fw[:, k - 1])
        z = np.logaddexp.reduce(fw[:, -1], axis=1)
        for k in range(length - 2, -1, -1):
            step = np.logaddexp.reduce(pair[None] + (emit[:, k + 1] + bw[:, k + 1])[:, None, :], axis=2)
            bw[:, k] = np.where(mask[:, k + 1, None], step, bw[:, k + 1])
        marginal = np.exp(fw[..., 1] + bw[..., 1] - z[:, None])
        joint = np.exp(fw[:, :-1, :, None] + pair + (emit[:, 1:] + bw[:, 1:])[:, :, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        p = np.zeros(len(x))
        p[slot[mask]] = marginal[mask]
        g = np.concatenate([(y - p) @ x / len(x) - l2 * unary, ((pairs_seen - joint.sum((0, 1))) / len(x) - l2 * pair).ravel()])
        moments = [0.9 * moments[0] + 0.1 * g, 0.999 * moments[1] + 0.001 * g * g]
        move = rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-8)
        unary, pair = unary + move[:-4], pair + move[-4:].reshape(2, 2)
    return Chain(unary, pair)


# --- labelled pages -----------------------------------------------------------------------------------------------

_NOTICES = {
    "en": ("We use cookies to give you the best service.| Accept all | Settings", "This site uses cookies.| Learn more OK", "By browsing on you accept our use of cookies.| OK", "Your privacy matters to us.| Reject all Accept selected", "We and our 31 partners store data on your device.| Manage choices"),
    "de": ("Wir verwenden Cookies für unsere Dienste.| Alle akzeptieren | Einstellungen", "Diese Seite verwendet Cookies.| OK", "Mit der Nutzung stimmen Sie der Verwendung von Cookies zu.| OK", "Wir und unsere 12 Partner speichern Daten auf Ihrem Gerät.| Auswahl verwalten"),
    "fr": ("Nous utilisons des cookies. Ce site utilise des cookies.| Tout accepter | Paramétrer", "En poursuivant, vous acceptez l'utilisation de cookies.| En savoir plus", "Nos 20 partenaires et nous stockons des informations.| Gérer mes choix"),
    "es": ("Esta web utiliza cookies propias.| Aceptar todo | Configurar", "Si sigue navegando acepta nuestra política de cookies.| Más información"),
    "it": ("Questo sito utilizza i cookie.| Accetta tutto | Impostazioni", "Continuando accetti l'uso dei cookie.| Maggiori informazioni"),
    "pt": ("Este site utiliza cookies.| Aceitar tudo | Definições", "Ao continuar aceita a nossa política de cookies.| Saber mais"),
    "nl": ("Deze site gebruikt cookies.| Alles accepteren | Instellingen", "Door verder te gaan aanvaardt u ons cookiebeleid.| Meer informatie"),
    "ru": ("Этот сайт использует файлы cookie.| Принять все | Настройки", "Продолжая просмотр, вы соглашаетесь с использованием cookie.| Подробнее"),
}
_FOOTERS = {
    "en": "© 2019 {n}. All rights reserved.| Privacy policy | Terms of use;Copyright 2021 {n} Ltd.| Registered office: see imprint.;Powered by {n} CMS – Imprint – Sitemap – Back to top;Follow us on social media   Newsletter   RSS   Accessibility",
    "de": "© 2019 {n}. Alle Rechte vorbehalten.| Impressum | Datenschutz;Folgen Sie uns   Newsletter   RSS   Impressum;Nach oben – Sitemap – AGB;AGB | Widerruf | Barrierefreiheit",
    "fr": "© 2019 {n}. Tous droits réservés.| Mentions légales | Confidentialité;Haut de page – Plan du site – Conditions d'utilisation",
    "es": "© 2019 {n}. Todos los derechos reservados.| Aviso legal | Privacidad;Volver arriba – Mapa del sitio – Condiciones de uso",
    "it": "© 2019 {n}. Tutti i diritti riservati.| Note legali | Privacy;Torna su – Mappa del sito – Condizioni d'uso",
    "pt": "© 2019 {n}. Todos os direitos reservados.| Aviso legal | Privacidade;Voltar ao topo – Mapa do site – Condições de utilização",
    "nl": "© 2019 {n}. Alle rechten voorbehouden.| Privacy | Voorwaarden;Naar boven – Toegankelijkheid – Voorwaarden",
    "ru": "© 2019 {n}. Все права защищены.| Конфиденциальность | Условия использования;Наверх – Карта сайта – Условия использования",
}
_PROMPTS = {
    "en": "Share this on social media;Advertisement;Print this page;Subscribe to our newsletter;Get our app for phones and tablets;Leave a comment (12);Sign in to comment;Skip to main content;Previous post | Next post;Back to home page",
    "de": "Artikel teilen;Anzeige;Newsletter abonnieren;Kommentare (7);Zum Inhalt springen",
    "fr": "Partager cet article;Publicité;S'abonner à la newsletter;Commentaires (3)",
    "es": "Compartir este artículo;Publicidad;Suscríbase al boletín;Comentarios (5)",
    "it": "Condividi questo articolo;Pubblicità;Iscriviti alla newsletter;Commenti (5)",
    "pt": "Partilhar este artigo;Publicidade;Subscrever a newsletter;Comentários (5)",
    "nl": "Deel dit artikel;Advertentie;Abonneer op de nieuwsbrief;Reacties (5)",
    "ru": "Поделиться статьёй;Реклама;Подписаться на рассылку;Комментарии (5)",
}
_SIDES = {
    "en": "Related articles;You may also like;Most read this week;Tags in this section", "de": "Ähnliche Artikel;Meistgelesen", "fr": "Articles similaires;Les plus lus", "es": "Artículos relacionados;Lo más leído",
    "it": "Articoli correlati;I più letti", "pt": "Artigos relacionados;Mais lidas", "nl": "Gerelateerde artikelen;Meest gelezen", "ru": "Похожие статьи;Самое читаемое",
}
#: Sentences that speak of such things are body.
_TRAPS = (
    "The baker says his cookies taste best when they are warm.", "All rights to the story were sold to a publisher in spring.", "You can contact us by letter, the farmer wrote in his note.", "She likes to share this bench with the neighbours.",
    "The advertisement in the paper was from the year 1952.", "Accept that the first cookies will burn, and try again.", "Search the cellar first, he said, and then the roof.", "The home team won, and the help of the crowd was praised.",
    "He printed this page of the book by hand.", "The menu of the inn had three soups and a pie.", "Der Kontakt zur Werkstatt war nach dem Sturm nicht möglich.", "La recherche a été longue, mais le village est content.", "La tienda de la plaza abre a las nueve y nadie lo sabe.",
)


#: Furniture by kind and language that pages are composed with.
VOCABULARY = {"nav": NAV, "notices": _NOTICES, "prompts": _PROMPTS, "sides": _SIDES, "footers": _FOOTERS}


def compose(samples: list[tuple[str, str]], n: int = TRAIN_PAGES, seed: int = 11, vocabulary: dict[str, dict] = VOCABULARY) -> tuple[list[str], list[list[tuple[str, int]]], list[str]]:
    """Labelled pages: text, labelled pieces in order, and title. ``samples`` are (language, clean text)."""
    import re

    menus, notices, prompts, sides, footers = (vocabulary[k] for k in ("nav", "notices", "prompts", "sides", "footers"))

    rng = random.Random(seed)
    sentences: dict[str, list[str]] = {}
    for lang, text in samples:
        sentences.setdefault(lang, []).extend(s.strip() for s in re.split(r"(?<=[.!?…])\s+", text or "") if len(s.split()) > 3)
    langs = sorted(set(sentences) & set(menus))
    pages, labels, titles = [], [], []

    def title(lang: str) -> str:
        if rng.random() < 0.2:
            q = rng.choice(sentences[lang]).rstrip(".!?…").split()
            return " ".join(q[: rng.randint(3, 5)]) + rng.choice(["?", " ?"])
        q = rng.choice(sentences[lang]).rstrip(".!?…").split()
        return " ".join(q[: rng.randint(3, 8)]).rstrip(",;:")

    def junk() -> list[str]:
        kind = rng.randrange(12)
        rows = rng.randint(4, 12)
        if kind >= 10:
            word = rng.choice(["Cheap Paint", "Roof Tiles", "Hotel", "Garten Möbel", "Lampe"])
            return [f"{word} {rng.choice(['Northam', 'Eastby', 'Southwell', 'Westley'])}{rng.choice(['', f' ({rng.randint(1, 90)})', ' >>', ' - online', ' - cheap'])}" for _ in range(rows + 2)]
        if kind == 0:
            return [f"{rng.choice('*•-')} {rng.randint(1, 20)} kg {rng.choice(['apples', 'plums', 'nails', 'red onions'])}" for _ in range(rows)]
        if kind == 1:
            return [f"{rng.choice(['Northam', 'Eastby', 'Southwell'])} | {rng.randint(1, 999)} | {rng.random():.2f} | yes" for _ in range(rows)]
        if kind == 2:
            return [f"let x{k}=f({k}); if(x{k}){{run(x{k});}}" for k in range(rows)]
        if kind == 3:
            return [f"{rng.choice(['cheap', 'best', 'buy'])} {w} | {w} online | {w} near me" for w in rng.choices(["paint", "roof tiles", "hotel"], k=rows)]
        if kind == 5:
            return [" ".join([rng.choice(["Northam", "Eastby", "Southwell"])] + [f"{rng.randint(5, 22):02}:{rng.randint(0, 59):02}" for _ in range(4)]) for _ in range(rows)]
        if kind == 6:
            return [f"0x{rng.getrandbits(32):08x}: " + " ".join(f"{rng.getrandbits(16):04x}" for _ in range(6)) for _ in range(rows)]
        if kind == 7:
            return [f"{rng.randint(100, 999)};{rng.choice(['apples', 'red onions'])};{rng.random() * 9:.1f};03.02.2021;A" for _ in range(rows)]
        if kind == 8:
            return ["".join(rng.choices("ABCDEFabcdefxyz0123456789+/", k=60)) for _ in range(rows)] + ["".join(rng.choices(["###", "~", "||", ">>>", "***", "=", "...", " "], k=40))]
        if kind == 9:
            return [f"{rng.choice(['Door', 'Window'])}: {rng.randint(9, 99)} x {rng.randint(9, 99)} (M) [{rng.randint(1, 99)}-B]" for _ in range(rows)]
        if kind == 4:
            return ["".join(rng.choices("bcdfgh jklmnp", k=40)) for _ in range(rows)]
        return [f"{k + 1}. {rng.choice(['old', 'new'])} {rng.choice(['mill', 'barn', 'gate'])}" for k in range(rows)]

    for _ in range(n):
        lang = rng.choice(langs)
        nav = menus[lang].split("|")
        name = "".join(rng.choices("abcdelmnorst", k=6)).title() + " " + rng.choice(["Post", "Guide", "Journal"])
        head = title(lang)
        lines: list[list[tuple[str, int]]] = []
        furnished = rng.random() < 0.75
        if furnished and rng.random() < 0.5:
            lines.append([(p.strip(), 1) for p in rng.choice(notices[lang]).split("|", 1)])
        if furnished and rng.random() < 0.6:
            items = rng.sample(nav, min(len(nav), rng.randint(3, 9)))
            if rng.random() < 0.25:
                lines += [[(i, 1)] for i in items]
            else:
                lines.append([(rng.choice([" | ", " · ", " / ", " > ", " - ", "   ", " "]).join(items), 1)])
        if furnished and rng.random() < 0.4:
            sep = rng.choice([" » ", " / ", " > "])
            lines.append([(sep.join(rng.sample(nav, 2) + [head]), 1)])
        if rng.random() < 0.5:
            lines.append([(head, 0)])
        if rng.random() < 0.12:
            lines += [[(r, 0)] for r in junk()]
        bare = rng.random() < 0.15  # nothing but rows
        if bare:
            lines += [[(r, 0)] for r in junk()]
        for _ in range(0 if bare else rng.randint(1, 6)):
            pool = rng.choices(sentences[lang], k=rng.randint(1, 3))
            if rng.random() < 0.1:
                pool.append(rng.choice(_TRAPS))
            lines.append([(" ".join(pool), 0)])
            if furnished and rng.random() < 0.25:
                lines.append([(rng.choice(prompts[lang].split(";")), 1)])
                if rng.random() < 0.4:
                    lines += [[(title(lang), 1)] for _ in range(rng.randint(1, 4))]
            if furnished and rng.random() < 0.2:
                lines.append([(rng.choice(sides[lang].split(";")), 1)])
                lines += [[(title(lang), 1)] for _ in range(rng.randint(0, 4))]
        if furnished and rng.random() < 0.6:
            if rng.random() < 0.3:
                lines.append([(rng.choice(prompts[lang].split(";")), 1)])
            lines.append([(p.strip(), 1) for p in rng.choice(footers[lang].split(";")).replace("{n}", name).split("|", 1)])
        elif furnished and rng.random() < 0.4:
            lines.append([(rng.choice(prompts[lang].split(";")), 1)])
        if rng.random() < 0.3:  # cut off at a length, as crawlers do
            while len(lines) > 2 and (len(lines[-1]) > 1 or lines[-1][0][1] == 1):
                lines.pop()
            t, label = lines[-1][-1]
            if label == 0 and len(t) > 12:
                lines[-1] = [*lines[-1][:-1], (t[: rng.randint(8, len(t) - 1)].strip(), 0)]
        flat = [p for line in lines for p in line]
        glue = " " if rng.random() < 0.4 else "\n"
        pages.append(glue.join(t for t, _ in flat))
        labels.append(flat)
        titles.append(head if rng.random() < 0.8 else "")
    return pages, labels, titles


def as_html(pages: list[str], pieces: list[list[tuple[str, int]]], share: float = 0.25, seed: int = 3) -> list[str]:
    """A share of composed pages as HTML; its boxes are mostly, but not always, those that fit."""
    rng = random.Random(seed)
    out = []
    for page, own in zip(pages, pieces):
        if rng.random() >= share or any("<" in t or "&" in t for t, _ in own):
            out.append(page)
            continue
        html = ["<html><body>"]
        for t, label in own:
            box = rng.choice(["nav", "header", "aside", "footer", "form", "nav"]) if label else rng.choice(["article", "main", "article"])
            box = rng.choice(["div", "section"]) if rng.random() < 0.25 else box
            leaf = rng.choice(["a", "li", "span"]) if label else "p" if len(t) > 60 else rng.choice(["h1", "p", "span"])
            html.append(f"<{box}><{leaf}>{t}</{leaf}></{box}>")
        out.append("".join([*html, "</body></html>"]))
    return out


def _labels(b: Blocks, pages: list[str], pieces: list[list[tuple[str, int]]]) -> np.ndarray:
    """The label of the piece that holds the middle of each block."""
    y = np.zeros(len(b), dtype=np.int64)
    text = b.text.to_pylist()
    doc, at = -1, 0
    spans: list[tuple[int, int]] = []
    for k, t in enumerate(text):
        if b.doc[k] != doc:
            doc, at, end = b.doc[k], 0, 0
            spans = []
            for piece, label in pieces[doc]:
                end = pages[doc].find(piece, end) + len(piece)
                spans.append((end, label))
        found = pages[doc].find(t, at)
        at = found if found >= 0 else at
        middle = at + len(t) // 2
        y[k] = next((label for end, label in spans if middle < end), 0)
        at += len(t)
    return y


#: Features that say that a block is on a list of phrases; a notice in a whole sentence can be told by its words only, so those of notices and footers stay.
LISTED = [FEATURES.index(k) for k in ("entry", "prompt", "heading")]


def unlisted(x: np.ndarray, b: Blocks, near: bool = True) -> np.ndarray:
    """The features as they are for furniture that no list holds: what the lists say of a block and of its neighbours is gone."""
    x = x.copy()
    x[:, LISTED] = 0
    if near:
        x[:, [FEATURES.index(k) for k in ("after entry", "before entry", "near entries", "after heading", "after cookie", "after ad or prompt")]] = 0
    return x


def train(samples: list[tuple[str, str]], common: CommonWords, n: int = TRAIN_PAGES, seed: int = 11, hidden: float = HIDDEN) -> Chain:
    """Fit the chain on composed pages; in a share of ``hidden`` of them the lists of phrases say nothing, so that shape, place and neighbours must."""
    pages, pieces, titles = compose(samples, n, seed)
    pages = as_html(pages, pieces)
    b = Blocks(pa.array(pages, pa.string()), pa.array(titles, pa.string()))
    x, _ = features(b, common, pa.array(titles, pa.string()))
    rng = np.random.default_rng(seed)
    blind = (rng.random(b.n_docs) < hidden)[b.doc]
    return fit(np.where(blind[:, None], unlisted(x, b), x), b.doc, _labels(b, pages, pieces))


def tag(pages: pa.Array, titles: pa.Array | None, chain: Chain, common: CommonWords) -> tuple[Blocks, np.ndarray, dict[str, np.ndarray]]:
    """Blocks of pages with the state of each and their sentence shape."""
    b = Blocks(pages, titles)
    x, shape = features(b, common, titles)
    return b, chain.decode(x, b.doc, b.n_docs), shape


def word_lists(common: DataFrame) -> CommonWords:
    """The frequent words of each language, from a table that does not grow."""
    words: dict[str, list[str]] = {}
    for r in common.select("lang", "word").where("lang is not null and word is not null").collect():
        words.setdefault(r.lang, []).append(r.word)
    return CommonWords(words)


def load(samples: DataFrame, common: DataFrame) -> tuple[Chain, CommonWords]:
    """Model and word lists from ``lang_samples`` and ``common_words``, both tables that do not grow; fitted once and kept."""
    from . import blocks, furniture, models

    cw = word_lists(common)
    rows = [(r.lang, r.text) for r in samples.select("lang", "text").orderBy("lang", "text").collect()]
    key = models.digest([*rows, *cw.words.items()], inspect.getmodule(load), blocks, furniture)

    def fresh() -> models.Arrays:
        chain = train(rows, cw)
        return {"unary": chain.unary, "pair": chain.pair}

    got = models.fitted(samples.sparkSession, "page-tagger", key, fresh)
    return Chain(got["unary"], got["pair"]), cw


def furniture_lines(df: DataFrame, tbl: str, id_col: str, text_col: str, title_col: str | None, chain: Chain, common: CommonWords) -> DataFrame:
    """``(tbl, id, line_no)`` of lines that are or hold furniture."""
    shared = df.sparkSession.sparkContext.broadcast((chain, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                b, state, _ = tag(s.column(1), s.column(2), model, words)
                at = np.flatnonzero(state == 1)
                key = np.unique(b.doc[at].astype(np.int64) * (1 << 32) + b.line[at])
                ids = s.column(0).take(pa.array(key >> 32))
                yield pa.RecordBatch.from_arrays([ids, pa.array((key & 0xFFFFFFFF).astype(np.int32))], names=["id", "line_no"])

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(title_col) if title_col else F.lit(None)).cast("string").alias("title")).where("text is not null and text <> ''")
    return src.mapInArrow(run, "id bigint, line_no int").select(F.lit(tbl).alias("tbl"), "id", "line_no")


def main_bodies(df: DataFrame, tbl: str, id_col: str, text_col: str, title_col: str | None, chain: Chain, common: CommonWords) -> DataFrame:
    """``(tbl, id, body)`` of every row: the body blocks, lines kept."""
    shared = df.sparkSession.sparkContext.broadcast((chain, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                s = whole.slice(lo, _SLAB)
                b, state, _ = tag(s.column(1), s.column(2), model, words)
                out: list[list[str]] = [[] for _ in range(s.num_rows)]
                text, last = b.text.to_pylist(), (-1, -1)
                for k in np.flatnonzero(state == 0).tolist():
                    d, line = int(b.doc[k]), int(b.line[k])
                    if last == (d, line):
                        out[d][-1] += " " + text[k]
                    else:
                        out[d].append(text[k])
                    last = (d, line)
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(["\n".join(x) for x in out], pa.string())], names=["id", "body"])

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(title_col) if title_col else F.lit(None)).cast("string").alias("title"))
    return src.mapInArrow(run, "id bigint, body string").select(F.lit(tbl).alias("tbl"), "id", "body")
