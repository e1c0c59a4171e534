r"""Problem 6: unfilled placeholders, filler, error pages and notices that scripts are needed, found in fields.

Fields are cut into segments (lines and sentences). Numbers, addresses, host names and dates are masked; every segment,
and every slot of a template language inside a segment, is a *unit* with an exact hash of its normal form. Units are
grouped by hash over sources, and the hashes that recur over at least ``SOURCES`` sources are classified by phrase and
slot rules (``MESSAGES``, ``RECURRING``, ``SLOT``). A rule reads the normal form only, which is the key of the grouping:
classifying before the grouping gives the same rows as after it, so units that no rule could classify are never
shuffled. A segment that speaks about such things (``ABOUT``) is no case.

In addition units of ``SLOT`` and ``MESSAGES`` count where their hash stands in one source only, as they are of one kind
wherever they stand; those of ``RECURRING`` do not. ``sources`` in the result tells which rows the recurrence carries.

Rules run in RE2 over Arrow batches, in time linear in the text whatever the number of rules. Hashes are reduced to one
row a task, hash and source before the shuffle; they go back to the units by a join on hash and salt, so that a message
that fills a third of all rows is spread over ``SALT`` tasks.

Defined results: null and empty fields give no row; repeated rows count as one source; a null source is a source of its
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut

SOURCES = 2
SALT = 16
_SLAB = 4000

_ID = r"[A-Za-z_]\w*(?:[._-]\w+)*"
#: Names of slots that are taken as such even in single brackets or braces in lower case.
_NAMES = r"(?:(?:first|last|user|full|company|product|site|page|post|item|your)[_ ]?)?(?:name|title|subtitle|headline|date|time|year|city|town|country|author|company|product|price|email|address|phone|url|link|image|description|summary|caption|teaser|page|site|user|username|item|post|category|content|text|body|excerpt|placeholder)"
#: Slots of template languages that hold an identifier (and perhaps a filter) and nothing else.
SLOT = "|".join(
    (
        rf"\{{\{{\{{?[#/!>&]?\s*{_ID}(?:\s*\|\s*\w+)*\s*\}}?\}}\}}", rf"[$#%@]\{{\s*{_ID}\s*\}}", rf"\{{[$:@!]\s*{_ID}\s*!?\}}", rf"<%[=-]?\s*{_ID}\s*%>", rf"\{{%\s*{_ID}\s*%\}}", rf"<\?(?:php)?[ =]*(?:echo )?\$?{_ID};?\s*\?>",
        rf"%%{_ID}%%", rf"@@{_ID}@@", rf"##{_ID}##", rf"\$\${_ID}\$\$", rf"\*\|{_ID}\|\*", rf"<<\s*{_ID}\s*>>", rf"\[\[\s*{_ID}\s*\]\]", rf"\[%\s*{_ID}\s*%\]",
        r"\b__[A-Za-z]+(?:[._][A-Za-z]+)*__\b", r"%\([A-Za-z_]\w*\)[sd]", r"[\[{][A-Z]{3,}(?:[_. ][A-Z]+)*[\]}]", r"[\[{][a-z]+(?:[_.][a-z]+)+[\]}]", rf"[\[{{](?i:{_NAMES})[\]}}]",
        r"\B%[A-Z][A-Z_]{2,}%\B", r"(?i:[\[<({]\s*(?:insert|enter|add|type|placeholder|your)\b[^\])}>\n]{1,40}[\])}>])", r"\bXXXX? \w+ XXXX?\b", r"\bT(?:ODO|BD|BC): ?\w+|\bFIXME\b|\[(?:TODO|TBD|TBC|TK)\]", r"\bYOUR_[A-Z_]+\b|\b[A-Z]+_(?:GOES_)?HERE\b",
    )
)
#: Before a slot in single brackets: signs that make it a part of something else.
_PART = r"[\w$#\[{]"

_SCRIPT = r"(?:java ?script|js|scripts?)"
_THING = r"(?:domain|site|web ?site|web ?page|page|account|blog|server|url|link|resource|file|document|app|application|service|shop|store|content|article|video|post|item)"
#: Whole segments or frames in normal form that are of one kind wherever they stand.
MESSAGES = "|".join(
    (
        # error pages
        r"^(?:http )?(?:error|erreur|fehler|ошибка|errore|erro|fout|error de|status|code)(?: code)? ?0\b(?: .{0,80})?$", r"^(?:error )?0[ –-]+(?:- )?(?:page |file )?(?:not found|forbidden|bad gateway|service|internal|gateway|unauthori[sz]ed|bad request|gone|too many|error|request|method not|not acceptable|moved|page|seite|página|pagina|страница)",
        r"\b(?:the )?page you(?: are looking for|'re looking for|’re looking for| were looking for| requested| tried| have requested)\b", r"^(?:sorry,? |oops,? |oops |whoops,? )?(?:page|file|site|this page|that page|the page)(?: you requested)? (?:was |is |could |can |cannot |can't |can’t |isn't |does not |doesn't |no longer )*(?:be )?(?:not )?(?:found|exist|exists|available|displayed)\W*0?\W*$",
        r"\brequested (?:url|page|resource|document|file|address)\b.{0,80}\b(?:not found|not exist|could not|no longer|unavailable)", r"^(?:sorry,? |oops,? )?(?:we )?(?:can't|cannot|couldn't|could not|can’t) find (?:the|that|this) page\b.{0,40}$", r"^nothing (?:was )?found(?: here)?$", r"^it (?:looks|seems) like nothing was found\b",
        r"\bseite (?:wurde |konnte |existiert |ist )?(?:leider )?nicht (?:mehr |gefunden|verfügbar|vorhanden)", r"\b(?:angeforderte|gesuchte|gewünschte) seite\b.{0,40}\b(?:nicht|existiert)", r"\bpage (?:demandée|non trouvée|introuvable)\b|\bpage que vous (?:cherchez|recherchez|demandez)\b",
        r"\bpágina (?:no encontrada|não encontrada|no disponible|não disponível|solicitada)\b|\bno (?:se )?(?:ha |pudo )?(?:encontrado|encontrar|encontramos) la página\b", r"\b(?:contenido|página|conteúdo) que (?:busca|procura|solicita)\b", r"\bpagina (?:non trovata|niet gevonden|richiesta|bestaat niet|non disponibile|niet beschikbaar)\b|\bgevraagde pagina\b",
        r"страница не (?:найдена|существует)|(?:запрашиваем|запрошенн)\S* страниц", r"^access (?:denied|forbidden|to this (?:page|site|resource).{0,30}denied)", r"^(?:zugriff verweigert|accès (?:refusé|interdit)|acceso denegado|accesso negato|acesso negado|toegang geweigerd|доступ (?:запрещён|запрещен|закрыт))",
        r"^you (?:do not|don't|don’t) have (?:the )?(?:permission|rights|access) to\b|^you are not (?:authorized|authorised|allowed) to\b", r"\binternal server error\b|^interner serverfehler|^erreur interne|^error interno|^errore interno|^erro interno|^interne serverfout|^внутренняя ошибка",
        r"\bserver encountered an (?:internal|unexpected)\b|\bunable to complete your request\b", r"^(?:0 )?(?:the )?(?:service|server|site|website) (?:is )?(?:temporarily |currently )?(?:unavailable|down|overloaded|offline)\b", r"^(?:0 )?bad gateway\b|^(?:0 )?gateway time-?out\b|^(?:0 )?forbidden$|^(?:0 )?too many (?:requests|connections)\b|^rate limit exceeded\b|^(?:0 )?method not allowed\b",
        r"^error establishing a (?:database|database connection)|\bdatabase (?:error|connection (?:failed|error))\b", r"\bsqlstate\[|\berror in your sql syntax\b|\bmysqli?_\w+\(|\bora-0\b", r"^(?:php )?(?:fatal error|parse error|warning|notice|deprecated|uncaught \w+|unhandled exception)\b ?.{0,200}\b(?:on line 0|failed to open stream|undefined|uncaught|unexpected|no such file|in /)",
        r"^traceback \(most recent call last|^(?:\w*(?:key|type|value|attribute|index|name|reference|syntax|runtime|import)error)\b|^stack trace\b|^exception in thread\b|\bnullpointerexception\b|\bobject reference not set to an instance\b|^segmentation fault", r"\berror (?:has |was )?(?:just )?occurred\b.{0,60}$|\bsomething went wrong\b.{0,40}$|^an unexpected error\b",
        r"^(?:this )?(?:site|page|website) (?:can't|cannot|can’t) be reached\b|^this page isn['’]t working\b|\bdns_probe\w*|\berr_\w+", r"\b(?:connection|request|session|verbindung|gateway) (?:has |was |is )?(?:timed out|time-?out|refused|reset)\b.{0,30}$", r"^(?:the )?(?:video|content|article|post|page|document|file|offer|listing|item) (?:you .{0,20})?(?:is|was|has been|is no) (?:no )?(?:longer )?(?:available|unavailable|removed|deleted)\b",
        # blocks
        r"\b(?:systems? (?:have|has) detected|detected) (?:some )?(?:unusual|suspicious) (?:traffic|activity)\b", r"\bchecking (?:your browser|if the site connection)\b|\bverify(?:ing)? (?:that )?you(?:['’]re| are) (?:a )?human\b|\b(?:prove|confirm|check) (?:that )?you(?:['’]re| are) (?:not a robot|human)\b|^are you a (?:robot|human)$|^i(?:['’]m| am) not a robot$",
        r"^attention required\b|^ddos protection by\b|\bcomplete the (?:security check|captcha)\b|^(?:your )?(?:request|ip|ip address|access|connection) (?:has been|was|is|have been) (?:blocked|denied|rejected|banned|limited)\b|^you have been blocked\b|^(?:cloudflare )?ray id\b|^security check\b.{0,20}$",
        r"^(?:your )?session (?:has |is )?(?:expired|timed out|ended)\b|^(?:ihre )?sitzung (?:ist )?abgelaufen|^(?:votre )?session (?:a )?expiré|^(?:su |la |sua |a )?(?:sesión|sessão) (?:ha |foi )?(?:expirad|caducad|expirou|terminad)|^(?:la )?sessione (?:è )?scaduta|^(?:uw )?sessie (?:is )?verlopen|^(?:ваша )?сессия (?:истекла|завершена)",
        # scripts
        rf"\b(?:enable|activate|turn on|allow|switch on|require|requires|needs?|without) (?:the )?{_SCRIPT}\b(?: .{{0,60}})?(?:$|\bto |\bin |\band |\bon )", rf"^{_SCRIPT} (?:is|are|must be|has to be|needs to be|seems? to be|appears? to be|have been|has been) (?:currently )?(?:not )?(?:disabled|enabled|required|off|turned off|turned on|blocked|needed|active|available|supported|switched off)",
        rf"\bbrowser (?:does not|doesn['’]t|is not able to) (?:support|run|allow) {_SCRIPT}\b|\b{_SCRIPT} (?:disabled|turned off|switched off|blocked) in your browser\b|^(?:please )?(?:reload|refresh) (?:the |this )?page with {_SCRIPT}\b",
        rf"\b(?:aktivieren sie|benötigt|erfordert|verwendet|braucht|aktiviere|ohne) (?:bitte )?{_SCRIPT}\b(?:.{{0,60}}$)|\b{_SCRIPT} (?:ist (?:deaktiviert|ausgeschaltet|erforderlich)|muss|aktivieren|einschalten)\b", rf"\b(?:activer|activez|nécessite|requiert|désactivé) (?:le )?{_SCRIPT}\b|\b{_SCRIPT} (?:est (?:désactivé|requis|nécessaire)|doit être)",
        rf"\b(?:habilitar|active|activar|activa|habilite|habilita|necesita|requiere|precisa de) (?:el )?{_SCRIPT}\b|\b{_SCRIPT} (?:está (?:desactivado|deshabilitado|desativado|desabilitado)|es necesario|é necessário)\b", rf"\b(?:abilitare|attivare|abilita|attiva|abilitate|richiede|necessita di) {_SCRIPT}\b|\b{_SCRIPT} (?:è (?:disabilitato|disattivato|richiesto|necessario))\b",
        rf"\b(?:ativar|ative|ative o|habilite o|requer|necessita de) {_SCRIPT}\b", rf"\b(?:schakel|vereist|gebruikt|activeer|zet) {_SCRIPT}\b.{{0,40}}$|\b{_SCRIPT} (?:is (?:uitgeschakeld|vereist|nodig)|inschakelen|aanzetten)\b", rf"(?:включите|включить|требует|требуется|нужен|необходим|отключён|отключен|выключен) {_SCRIPT}\b|\b{_SCRIPT} (?:отключ|выключ|необходим|требуется|должен)",
        # maintenance
        r"^(?:this |the |our |we are |we're )?(?:site|page|website|shop|store)? ?(?:is |are )?(?:currently |temporarily )?(?:under|down for|closed for|offline for|undergoing) (?:scheduled |routine |planned )?(?:maintenance|construction)\b.{0,40}$|^scheduled maintenance$|^we(?:'ll|’ll| will) be (?:right )?back (?:soon|shortly)\b",
        r"^(?:diese |die )?(?:seite|website|webseite) (?:befindet sich |ist )?(?:in|im|wegen) (?:wartung|aufbau)|^wartungsarbeiten$|^site en (?:maintenance|construction)|^sitio en (?:mantenimiento|construcción)|^sito in (?:manutenzione|costruzione)|^(?:site|sítio) em (?:manutenção|construção)|^(?:site|website) in onderhoud|^сайт на (?:техническ|реконструкц|обслуж)",
        # filler and defaults
        r"\blorem ipsum dolor\b|\bconsectetur adipi\w+|\bsed do eiusmod\b|\but enim ad minim\b|\bduis aute irure\b|\bexcepteur sint\b|\bsed ut perspiciatis\b|\bneque porro quisquam\b|\bat vero eos et accusam|\bpellentesque habitant\b|\bvestibulum ante ipsum\b",
        r"^(?:this is (?:the|a|an|your|some) )?(?:default|placeholder|dummy|sample|filler|example|blank) (?:title|subtitle|headline|heading|description|summary|caption|teaser|paragraph|text|content|page|post|copy|document)\b(?: (?:for|goes|to be|-|–|here|do not|0).{0,40})?$", r"^(?:click|tap|double-?click|press)(?: here)? to (?:edit|add|change|insert|enter)\b",
        r"^(?:please )?(?:enter|type|add|put|write|insert|paste|place) (?:your |the |a |some |an )?(?:\w+ ){1,3}(?:here|text)$", r"^(?:your |the |more |some )(?:\w+ ){0,3}(?:goes|go|comes|will go|will appear|here) ?here$|^(?:your) (?:\w+ ){1,3}here$|^(?:title|text|content|headline|description|summary|caption|paragraph|name|subtitle|teaser)(?: text)? (?:goes |comes )?here$", r"^sample \w+ [-–] do not publish|\bdo not publish\b.{0,10}$",
        r"^(?:hier (?:steht|kommt|folgt) (?:ihr|der|ein|mein) (?:text|titel|inhalt)|(?:titel|text|inhalt|überschrift) hier (?:einfügen|eingeben)|(?:blind|muster|beispiel|platzhalter)text)\b", r"^(?:insérez|saisissez|ajoutez|entrez) (?:votre|le|un) (?:texte|titre|contenu)|^(?:votre|le) (?:texte|titre) ici|^texte (?:d['’]exemple|par défaut|factice)|^titre par défaut",
        r"^(?:inserte|introduzca|escriba|añada|insira|introduza|escreva|inserisci|inserire|scrivi|digite) (?:aquí |aqui |qui )?(?:su |el |o |seu |o seu |il |il tuo |un )?(?:texto|título|testo|titolo|contenido|conteúdo|contenuto)", r"^(?:texto|título|testo|titolo) (?:de|di|por|predefinito|predeterminado) ?(?:ejemplo|exemplo|esempio|relleno|defecto)?(?: aquí| aqui| qui)?$", r"^(?:voeg|vul|typ) hier (?:uw|je|de) (?:tekst|titel)|^(?:voorbeeld|standaard)tekst$|^standaardtitel$", r"^(?:вставьте|введите|добавьте) (?:сюда |здесь )?(?:ваш |свой )?(?:текст|заголовок)|^(?:пример|образец) (?:текста|заголовка)|^текст по умолчанию|^заголовок по умолчанию|^здесь (?:будет|должен быть) (?:ваш )?(?:текст|заголовок)",
        r"\[object object\]", r"\b(?:null null|undefined undefined|nan nan|undefined nan|null undefined)\b", r"^(?:new page(?: 0)?|untitled(?: document| page| post|-0| 0)?(?: 0)?|(?:new )?document ?0|ohne titel|unbenannt|sans titre|sin título|senza titolo|sem título|zonder titel|naamloos|без (?:названия|заголовка|имени)|neue seite(?: 0)?|nouvelle page(?: 0)?|nueva página(?: 0)?|nuova pagina(?: 0)?|nova página(?: 0)?|nieuwe pagina(?: 0)?|новая страница(?: 0)?)$",
        r"^just another \w+ (?:site|blog|weblog)$|^welcome to wordpress\b|^this is your first post\b|^welcome to nginx\b|\b(?:apache0?|nginx) .{0,20}default page\b|^if you (?:see|are seeing|can see) this page\b|^index of /", r"^(?:test ){2,}test$|^(?:test|blah|foo|asdf)(?: (?:test|blah|bar|asdf|baz))+$|^(?:asdf|qwerty|foobar)\w*$",
    )
)

#: Whole segments and frames in normal form that are residue only if they recur over sources.
RECURRING = "|".join(
    (
        r"^(?:just a moment|loading|(?:loading\W+)?please wait|coming soon|under construction|undefined|null|nan|none|nginx|apache|test page|test|forbidden|access denied|contact the (?:administrator|webmaster|site owner)|please try again later|please log in again to continue|replace it|page not found|attention required|hello world|not found|not acceptable|bad request|too many requests|it works|default page|your site title here|home page title|sample page|example page|insert title here|redirecting|please stand by|one moment please|no title|title|headline|n/a|tbd|todo|placeholder|no content|no description(?: available)?|no results(?: found)?|content|untitled)\W*0?\W*$",
        r"^(?:bitte warten|wird geladen|lädt|demnächst|veuillez patienter|chargement(?: en cours)?|bientôt disponible|cargando|espere por favor|un momento por favor|próximamente|caricamento(?: in corso)?|attendere(?: prego)?|prossimamente|a carregar|carregando|aguarde(?: por favor)?|em breve|even geduld(?: aub)?|laden|bezig met laden|binnenkort(?: beschikbaar)?|загрузка|идёт загрузка|подождите|пожалуйста, подождите|скоро)\W*$",
        r"^(?:your|insert|add|enter|type|default|sample|example|untitled|dummy|edit|choose|set)(?: \w+){0,3} (?:title|subtitle|headline|heading|subheading|tagline|slogan|caption|teaser|summary|description|text|name|content|copy|paragraph)(?: (?:goes )?here)?$",
        rf"^(?:this|the|your|our) {_THING}(?: name)?(?: @)? (?:is|has been|was|has|may be|may have been|could not be|cannot be|can't be|does not|doesn't|isn't)\b.{{0,40}}\b(?:parked|for sale|suspended|disabled|expired|unavailable|available|found|moved permanently|deleted|blocked|offline|exist|displayed|loaded|reached|maintenance|construction|registered|configured|removed|restricted)\b",
        rf"^(?:@|{_THING}(?: name)?)(?: @)? (?:is |has been )?(?:parked|for sale|suspended|expired|unavailable|not available|disabled|offline|removed|deleted)\b.{{0,30}}$", r"^(?:buy|register|renew) this domain\b", r"^(?:parked|expired) domain\b",
        r"^diese (?:domain|seite|website|webseite)(?: @)? (?:ist|wurde|steht)\b.{0,40}\b(?:geparkt|verkaufen|verkauf|verfügbar|erreichbar|gesperrt|wartung)", r"^ce (?:domaine|site)(?: @)? (?:est|n'est|a été) .{0,40}\b(?:parqué|vendre|disponible|suspendu|maintenance)",
        r"^este (?:dominio|sitio|domínio|site)(?: @)? (?:está|no está|não está|ha sido|foi) .{0,40}\b(?:aparcado|estacionado|venta|venda|disponible|disponível|suspendido|suspenso|mantenimiento|manutenção)", r"^questo (?:dominio|sito)(?: @)? (?:è|non è) .{0,40}\b(?:parcheggiato|vendita|disponibile|sospeso|manutenzione)",
        r"^dit domein(?: @)? is\b.{0,40}\b(?:geparkeerd|koop|beschikbaar)", r"^этот (?:домен|сайт)(?: @)? .{0,40}(?:припаркован|продаётся|продается|недоступен|приостановлен)",
        r"^(?:please )?(?:refresh|reload) (?:the|this|your) (?:page|browser)\b", r"^(?:please )?(?:try again|check back|come back)(?: (?:later|soon|in a .{0,20}|shortly))?$", r"^(?:please )?(?:log|sign) ?in (?:again )?to (?:continue|view|access|see)\b", r"^(?:please )?(?:enable|allow|accept) cookies\b", r"^cookies (?:are|must be) (?:disabled|enabled|required|turned off|blocked)\b",
        r"^your (?:browser|connection|ip|ip address|request|session)\b.{0,40}\b(?:not supported|unsupported|outdated|out of date|blocked|denied|rejected|timed out|expired|not private|processed|completed)\b|^(?:please )?(?:update|upgrade) your browser\b", r"^(?:oops|whoops|sorry)$", r"^no input file specified$", r"^cannot (?:get|post) /",
    )
)

#: Words of the classical filler passage (fixed values). Runs of them, in any order, have one normal form.
FILLER_WORDS = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat "
    "duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
FILLER = "lorem ipsum dolor"
_FILLER_RUN = rf"\b(?:(?:{'|'.join(FILLER_WORDS)})\b[\s,;]*){{5,}}"

#: Words of segments that speak about such things (fixed list).
ABOUT = r"(?i)\b(?:templates? (?:engine|language)|markers?|variables?|syntax|notation|shell scripts?|curly|literal(?:ly)?|printers|typesetters|filler for|words lorem|talk explained|article about|form has|still picture|vorlagen?|platzhalter|modèle de page|marqueur|plantillas?|segnaposto|sjabloon)\b|(?i:шаблон|переменн)|(?i)(?:^|[^<])\bplaceholders? (?:is|are|was|were|in|that)\b"

_END = "\x1f"
_SLOT_RE = re.compile(SLOT)


def alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern outside of groups and classes."""
    out, depth, in_class, start, at = [], 0, False, 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[start:at])
            start = at + 1
        at += 1
    return [*out, pattern[start:]]


def _apart(pattern: str) -> list[str]:
    """Alternatives that begin at the start of a segment, and the others: RE2 is a hundred times slower if they are mixed."""
    parts = alternatives(pattern)
    return ["|".join(p) for p in ([x for x in parts if x.startswith("^")], [x for x in parts if not x.startswith("^")]) if p]


_TOLD, _AGAIN = _apart(MESSAGES), _apart(RECURRING)


def _re2(arr: pa.Array, *patterns: str) -> np.ndarray:
    """Whether any of the patterns matches."""
    return np.logical_or.reduce([pc.match_substring_regex(arr, p).to_numpy(zero_copy_only=False) for p in patterns])


def mask(segments: pa.Array) -> pa.Array:
    """Normal form that is hashed: lower case, addresses, host names, dates, numbers and filler masked, blanks and end signs folded."""
    s = pc.replace_substring_regex(pc.utf8_lower(segments), _FILLER_RUN, FILLER + " ")
    s = pc.replace_substring_regex(s, r"(?:https?://|www\.)\S+|\S+@\S+", "@")
    s = pc.replace_substring_regex(s, r"(^|[^\w.-])(?:[\w-]+\.)+\p{L}{2,}", "\\1@")
    s = pc.replace_substring_regex(s, r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}|\d+", "0")
    return pc.utf8_trim_whitespace(pc.replace_substring_regex(s, r"[\s.!?…:]+", " "))


def split(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Segments (lines and sentences) of all values, and the value of each."""
    ends = pc.replace_substring_regex(pc.replace_substring_regex(values, r"[\r\n\x0b\x0c\x1f]+", _END), r"([.!?…])\s+", "\\1" + _END)
    lists = pc.split_pattern(ends, _END)
    owner = np.repeat(np.arange(len(values)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    text = pc.utf8_trim_whitespace(lists.flatten())
    keep = np.flatnonzero(pc.not_equal(text, "").to_numpy(zero_copy_only=False))
    return text.take(pa.array(keep)), owner[keep]


def slots(segment: str) -> list[str]:
    """Slots of a segment in normal form; one in single brackets must not be part of something else."""
    found = []
    for m in _SLOT_RE.finditer(segment):
        if m.group()[0] in "[{" and m.start() and re.match(_PART, segment[m.start() - 1]):
            continue
        found.append(re.sub(r"\d+", "0", re.sub(r"\s+", " ", m.group().lower())))
    return found


def fields_of(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", columns: tuple[str, ...] = ("text", "title")) -> DataFrame:
    """``(id, source, field, value)`` of fields that are not empty."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"), cells.alias("x")).select("id", "source", "x.field", "x.value").where("value is not null and trim(value) <> ''")


def units(fields: DataFrame) -> DataFrame:
    """``(id, source, field, kind, message, hash)``: all segments and slots whose normal form a rule classifies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLAB):
                b = whole.slice(lo, _SLAB)
                text, owner = split(b.column(3))
                normal = mask(text)
                told, again = _re2(normal, *_TOLD), _re2(normal, *_AGAIN)
                slotted = _re2(text, SLOT)
                some = np.flatnonzero(told | again | slotted)
                about = np.zeros(len(text), dtype=bool)
                about[some] = _re2(text.take(pa.array(some)), ABOUT)
                rows: list[tuple[int, str, str]] = []
                for k in np.flatnonzero(slotted & ~about).tolist():
                    rows += [(int(owner[k]), "placeholder", s) for s in slots(text[k].as_py())]
                for k in np.flatnonzero((told | again) & ~about).tolist():
                    rows.append((int(owner[k]), "message" if told[k] else "recurring", normal[k].as_py()))
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(3)), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["id", "source", "field", "kind", "message"])

    src = fields.select("id", F.coalesce("source", F.lit("")).alias("source"), "field", "value")
    return src.mapInArrow(run, "id bigint, source string, field string, kind string, message string").withColumn("hash", F.xxhash64("kind", "message"))


def counted(found: DataFrame) -> DataFrame:
    """``(hash, kind, message, fields, sources)`` of units, reduced to a row a task, hash and source before the shuffle."""
    per = found.groupBy("hash", "kind", "message", "source").agg(F.count("*").alias("n"))
    return per.groupBy("hash", "kind", "message").agg(F.sum("n").alias("fields"), F.count("*").alias("sources"))


def classify(fields: DataFrame, sources: int = SOURCES) -> DataFrame:
    """``(id, field, kind, sources)`` of every field with residue: the kind of its widest recurring unit and that unit's sources."""
    found = cut(units(fields))
    hashes = counted(found).select("hash", "sources").where((F.col("sources") >= sources) | (F.col("kind") != "recurring"))
    spread = hashes.select("hash", "sources", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salted = found.select("id", "field", "kind", "hash", F.pmod(F.xxhash64("id", "field"), F.lit(SALT)).cast("int").alias("salt"))
    joined = salted.join(spread, ["hash", "salt"])
    # the widest unit, of equal ones the least kind
    widest = joined.groupBy("id", "field").agg(F.max("sources").alias("sources"), F.min(F.struct(-F.col("sources"), "kind")).alias("m"))
    return widest.select("id", "field", F.col("m.kind").alias("kind"), "sources")


def messages(fields: DataFrame, sources: int = SOURCES) -> DataFrame:
    """Widely recurring units that a rule classifies, with their counts: ``(message, kind, fields, sources)``."""
    return counted(units(fields)).where(F.col("sources") >= sources).select("message", "kind", "fields", "sources")
