"""Problem 4: template residue, filler, error pages and script notices in place of text.

Placeholders are found by a grammar for each kind of delimiter. Whether one stands for itself or is only shown follows
from its surroundings: code around it, quotation, verbs of showing before or after it, and the density of words about
notation around it and in the whole text. The other kinds are told sentence by sentence, by a linear score over
features: what is said (a failure, a status, a wish for scripts, a stopgap), to whom (a reader, or nobody), how (as
happening now, or as a condition, a rule, an explanation), and how much of the text is said so. The words of the
features are lists by language (English, German, Spanish, French). One pass of an Aho-Corasick automaton tells which
sentences can score at all, so most texts meet no pattern.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows

# --- placeholders: one grammar for each pair of delimiters -------------------------------------------------------

_NAME = r"[A-Za-z][\w .:,/-]{0,60}?"
#: Words that ask somebody to fill in a field.
_ASK = r"(?:insert|enter|add|fill(?:\s+in)?|type|put|write|choose|select|specify|provide|replace|your|todo|tbd|tbc|tba|xxx+|name\s+of|date\s+of|placeholder)"
#: (delimiters, pattern). Inside the delimiters a name, an expression or a request is wanted, not any text.
GRAMMARS: list[tuple[str, str]] = [
    ("double braces", r"\{\{[^{}\n]{0,20}[A-Za-z][^}]{0,120}?\}\}"),
    ("statement braces", r"\{%[-\s]?[^%]{1,80}?%\}"),
    ("dollar braces", r"\$\{\s*[A-Za-z_][^}]{0,60}?\}"),
    ("dollar parentheses", r"\$\(\s*[A-Za-z_][\w. -]{0,60}\)"),
    ("hash braces", r"#\{\s*[A-Za-z_][^}]{0,60}?\}"),
    ("numbered braces", r"(?<![\w{$#\\])\{\d{1,2}\}(?!\})"),
    ("named braces", r"(?<![\w{$#\\])\{[a-z]+(?:_[a-z]+)*\}(?!\})"),
    ("server tags", r"<%[=#@-]?\s*[^%]{1,80}?%>"),
    ("double angles", r"<<\s*" + _NAME + r"\s*>>"),
    ("guillemets", r"«\s*" + _NAME + r"\s*»"),
    ("angle name", r"<(?:[A-Z][a-z]+|[A-Z]{2,}|your|insert|enter)(?:[ _-][A-Za-z]+){0,4}>"),
    ("escaped angles", r"&lt;\s*[A-Za-z][\w .-]{0,60}?&gt;"),
    ("double square", r"\[\[\s*[A-Za-z][^\]]{0,80}?\]\]"),
    ("square request", r"\[\s*" + _ASK + r"\b[^\]\[]{0,80}\]"),
    ("square todo", r"\[[^\]\[]{0,80}\b(?:tbd|tbc|tba|todo|here|to\s+be\s+\w+ed|to\s+come)\s*\]"),
    ("square capitals", r"\[[A-Z]{3,}(?:[ _][A-Z]{2,}){0,4}\](?!\()"),
    ("round request", r"\(\s*(?:name|date|number|title|value|text|place|amount)\s+of\s[^()]{1,60}?\sto\s+be\s+\w+\s*\)"),
    ("round to come", r"\([^()]{1,60}\s(?:to\s+be\s+(?:supplied|added|confirmed|determined|completed|inserted|filled(?:\s+in)?|provided|announced)|to\s+come|tbd|tbc)\s*\)"),
    ("double percent", r"%%\s*[A-Za-z][\w .-]{0,40}?%%"),
    ("single percent", r"(?<![\w%])%[A-Z]+(?:_[A-Z]+)*%(?![\w%])"),
    ("double at", r"@@\s*[A-Za-z][\w .-]{0,40}?@@"),
    ("double underscore", r"(?<!\w)__[A-Z][A-Z0-9_ -]{1,40}?__(?!\w)"),
    ("double hash", r"(?<!\S)##[A-Za-z][\w .-]{0,40}?##"),
    ("double tilde", r"~~[A-Z][A-Z_]{1,40}~~"),
    ("crosses", r"\bX{2,}[-_ ][A-Z][A-Z_ ]{1,40}[-_ ]X{2,}\b"),
    ("bars", r"\|\|[A-Z][A-Z_]{1,40}\|\|"),
    ("capitals to fill", r"\b(?:INSERT|ENTER|YOUR)_[A-Z][A-Z_]+\b|\bFILL_?ME(?:_?IN)?\b|\bFILL_IN(?:_\w+)?\b"),
]
_KEEP_CASE = {"named braces", "angle name", "square capitals", "single percent", "double underscore", "double tilde", "crosses", "bars", "capitals to fill"}
#: What a text must hold for each grammar to be tried at all.
_SIGNS = {
    "double braces": "{{", "statement braces": "{%", "dollar braces": "${", "dollar parentheses": "$(", "hash braces": "#{", "numbered braces": "{", "named braces": "{", "server tags": "<%", "double angles": "<<",
    "guillemets": "«", "angle name": "<", "escaped angles": "&lt;", "double square": "[[", "square request": "[", "square todo": "[", "square capitals": "[", "round request": " of", "round to come": "(", "double percent": "%%",
    "single percent": "%", "double at": "@@", "double underscore": "__", "double hash": "##", "double tilde": "~~", "crosses": "XX", "bars": "||", "capitals to fill": "_",
}
_COMPILED = [(name, _SIGNS[name], re.compile(p, 0 if name in _KEEP_CASE else re.I)) for name, p in GRAMMARS]
_ANY_SIGN = re.compile(r"[{<«\[(%@~|]|&lt;|&LT;|__|##|XX|[A-Z]_[A-Z]|FILL|\$\(")

#: The project's own brackets.
OWN = re.compile(r"\[\s*(?:assignment\s*:|selection\b)", re.I)
_CODE = re.compile(r"```|~~~|<(code|pre)\b|`[^`\n]+`", re.I)
_CODE_ENDS = {tag: re.compile(f"</{tag}>", re.I) for tag in ("code", "pre")}
#: Words about notation; how dense they stand tells a lesson from a form (fixed values).
NOTATION = re.compile(
    r"\b(?:syntax|notation|tutorial|lesson|placeholders?|variables?|braces|brackets|delimiters?|expressions?|snippets?|templating|template\s+(?:language|engine|file|string|syntax|tag)s?|render(?:s|ed|ing)?|interpolat\w+|escap(?:e|ed|es|ing)|example|e\.g\.|source\s+code|string|syntaktisch|platzhalter|variablen?|beispiel|ejemplo|sintaxis|exemple|syntaxe)\b", re.I
)
#: What is shown comes after or before verbs of showing (fixed values).
_SHOWN_BEFORE = re.compile(r"(?:\b(?:write|writes|written|wrote|type|types|typed|such\s+as|like|of\s+the\s+form|called|named|denoted(?:\s+by)?|as|syntax|notation|token|tag|variable|placeholder|expression|between|example|e\.g\.|i\.e\.)|[:=])\s*[\"'“‘(]?\s*$", re.I)
_SHOWN_AFTER = re.compile(r"^\s*[\"'”’)]?\s*(?:means|denotes|stands\s+for|is\s+(?:replaced|written|rendered|expanded|filled|a\s+placeholder|the\s+placeholder)|becomes|expands|renders|prints|->|=>|→|⇒|in\s+(?:double\s+)?(?:braces|brackets|quotes))", re.I)
_QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "„": "“", "«": "»"}
#: A placeholder counts unless its surroundings weigh as much; words about notation within so many characters count.
_CONTEXT, _AROUND = 0.8, 220


def _without_code(text: str) -> str:
    """A text with a space in place of each code block, of any length, in one pass. A tag that is never closed opens none."""
    kept, at, pos = [], 0, 0
    ends = dict(_CODE_ENDS)
    while m := _CODE.search(text, pos):
        pos = m.end()
        if m.group(1):
            tag = m.group(1).lower()
            # Where no end tag follows, none follows any later opening one.
            end = ends[tag].search(text, pos) if tag in ends else None
            if not end:
                ends.pop(tag, None)
                continue
            pos = end.end()
        elif m.group(0) in ("```", "~~~"):
            closed = text.find(m.group(0), pos)
            pos = closed + 3 if closed >= 0 else len(text)
        kept.append(text[at : m.start()])
        at = pos
    return " ".join([*kept, text[at:]])


def _shown(text: str, start: int, end: int) -> float:
    """How much speaks for a placeholder being shown, not left unfilled: quotation, verbs of showing, words about notation."""
    before, after = text[max(0, start - 60) : start], text[end : end + 60]
    weight = 0.0
    if before[-1:] in _QUOTES and after[:1] == _QUOTES[before[-1:]]:
        weight += 0.6
    if _SHOWN_BEFORE.search(before) and not before.rstrip().endswith(":"):
        weight += 0.6
    if _SHOWN_AFTER.search(after):
        weight += 0.8
    around = text[max(0, start - _AROUND) : start] + " " + text[end : end + _AROUND]
    words = around.count(" ") + 1
    return weight + 10.0 * sum(1 for _ in NOTATION.finditer(around)) / max(words, 20)


def _placeholder(text: str) -> str | None:
    """The first kind of placeholder that stands in the text for itself: neither in code nor shown as an example.

    Where half of the placeholders or more are shown and words about notation are dense in the whole text, it is a
    lesson, and none counts.
    """
    if not _ANY_SIGN.search(text):
        return None
    fenced = "`" in text or "~~~" in text or "</" in text
    prose = _without_code(text) if fenced else text
    lower = prose.lower()
    shown, first, total = 0, None, 0
    for name, sign, pattern in _COMPILED:
        if sign not in prose and sign not in lower:
            continue
        for m in pattern.finditer(prose):
            found = m.group(0)
            if found[0] == "[" and OWN.match(found):
                continue
            total += 1
            if _shown(prose, m.start(), m.end()) >= _CONTEXT:
                shown += 1
            else:
                first = first or name
    if first and shown and 2 * shown >= total:
        words = prose.count(" ") + 1
        if sum(1 for _ in NOTATION.finditer(prose)) >= 0.03 * words:
            return None
    return first


# --- pseudo-Latin, keyboard runs, repetition --------------------------------------------------------------------

#: Words of the printers' filler (fixed values).
PSEUDO_LATIN = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum vestibulum fringilla pellentesque curabitur aenean etiam phasellus tellus".split())
_LATIN_END = re.compile(r"(?:us|um|is|or|as|at|em|os|am|ae|ur|it|et|[aeo])$")
#: Common words of the corpus languages; a run of words without any is not a sentence in them.
COMMON = frozenset("the a an and or of to in on for is are was be by with as at from that this it its not no if when all any each must may should can will has have had but they them their our we you your one only before after which there so than el los las del que por con una para su les des du dans pour une sur pas au aux avec der die das und ist von mit dem den ein eine gli che per".split())
#: Keys that lie side by side, and stopgap words (fixed values).
KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn")
STOPGAP = frozenset("foo bar baz qux bla blah blabla xxx yyy zzz test tests testing".split())
_KEY_STARTS = tuple(sorted({row[i : i + 4] for row in KEYS for i in range(len(row) - 3)} | {"foo ", "bla ", "blah ", "xxx "}))
_ENDS = re.compile(r"\s*[.!?\n]+\s*")
_RUN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def _keyed(word: str) -> bool:
    return len(word) >= 4 and any(word in row or word[::-1] in row for row in KEYS)


def _keyboard(low: str) -> bool:
    """Keyboard mashing and stopgap words: five in a row, one of them typed along the keyboard, or eight."""
    run = keyed = 0
    for w in _RUN.findall(low):
        if _keyed(w):
            run, keyed = run + 1, keyed + 1
        elif w in STOPGAP:
            run += 1
        else:
            run = keyed = 0
        if run >= 5 and (keyed or run >= 8):
            return True
    return False


def _senseless(low: str) -> str | None:
    """Repetition of one short sentence, or pseudo-Latin. Latin that a text in some language quotes or speaks of is none,
    unless it makes up a third of it."""
    latin, words, last, again, spoken = 0, 0, "", 1, False
    for sentence in _ENDS.split(low):
        if sentence == last and sentence.count(" ") < 8 and len(sentence) > 3:
            again += 1
            if again >= 3 and " " in sentence.strip():
                return "repetition"
        else:
            last, again = sentence, 1
        # Sentences without a common word, most of whose words have Latin endings.
        if not COMMON.isdisjoint(sentence.split()):
            spoken = spoken or "lorem" in sentence or "ipsum" in sentence
            continue
        w = _RUN.findall(sentence)
        if len(w) < 3 or sum(x in PSEUDO_LATIN or bool(_LATIN_END.search(x)) for x in w) < 0.85 * len(w) or "|" in sentence or len(set(w)) == 1:
            continue
        latin += 1 + (len(w) >= 4 and not PSEUDO_LATIN.isdisjoint(w))
        words += len(w)
    if latin >= 2 and not (spoken and words < 0.33 * (low.count(" ") + 1)):
        return "pseudo-Latin"
    return None


# --- sentences: features and their weights -----------------------------------------------------------------------

_THING = r"(?:(?:web\s?)?(?:page|site)|document|file|resource|record|publication|chapter|link(?:\s+target)?|article|item|content|service|server|host|view|url|address|request|image|report|pdf|session|login|log-?in|connection|viewer|application|app|seite|dokument|datei|inhalt|dienst|sitzung|anfrage|página|documento|archivo|recurso|contenido|servicio|sesión|solicitud|fichier|ressource|contenu|session)"
_FAILED = (
    r"(?:(?:is|are|was|were)\s+(?:currently\s+|temporarily\s+)?(?:not\s+(?:available|found|accessible|reachable)|unavailable|inaccessible|unreachable|offline|down|gone|missing)|no\s+longer\s+(?:exists?|available)|does\s+not\s+exist|doesn'?t\s+exist|(?:could\s+not|couldn'?t|cannot|can'?t|can\s+not)\s+(?:be\s+(?:found|opened|loaded|displayed|shown|reached|retrieved|processed|completed)|reach|load|open|connect|start|respond)"
    r"|ha(?:s|ve)\s+(?:been\s+)?(?:taken\s+offline|moved|removed|deleted|renamed|withdrawn|expired|run\s+out|ended|timed\s+out|closed)|failed\s+to\s+(?:load|open|respond|start)|took\s+too\s+long|timed\s+out|expired|(?:sent|gave|returned)\s+no\s+(?:data|answer|reply|response)|did\s+not\s+(?:respond|answer|load)|is\s+only\s+open\s+to"
    r"|(?:konnte|kann|wurde|ist)\s+(?:\w+\s+){0,3}?nicht\s+(?:gefunden|geladen|geöffnet|angezeigt|erreicht|erreichbar|verfügbar)|ist\s+abgelaufen|nicht\s+mehr\s+verfügbar|no\s+(?:se\s+(?:ha\s+)?(?:pudo|puede|encontró|encontrado)|está\s+disponible|existe|fue\s+encontrad[oa])|ha\s+(?:caducado|expirado|sido\s+(?:movid|eliminad)[oa])|(?:est|a\s+été)\s+(?:introuvable|indisponible|déplacée?|supprimée?)|n'existe\s+(?:pas|plus)|n'a\s+pas\s+(?:pu|été)|a\s+expiré)"
)
_REASON = r"(?:not\s+found|forbidden|bad\s+(?:gateway|request)|access\s+(?:denied|forbidden)|permission\s+denied|internal\s+(?:server\s+)?(?:error|fault)|server\s+error|service\s+unavailable|gateway\s+time-?out|too\s+many\s+requests|unauthori[sz]ed|(?:request|connection|session|gateway)\s+(?:timed\s+out|time-?out|refused|reset|expired|blocked|rejected|denied)|gone|seite\s+nicht\s+gefunden|nicht\s+gefunden|zugriff\s+verweigert|interner\s+(?:server)?fehler|página\s+no\s+encontrada|no\s+encontrad[oa]|acceso\s+denegado|error\s+interno|page\s+introuvable|accès\s+refusé|erreur\s+interne)"
_JS = r"(?:java\s?scripts?|\bjs\b|ecmascript|(?:client-?side\s+|browser\s+)?scripts?\b|(?:client-?side\s+)?scripting\b|active\s+content|aktive\s+inhalte|skripte?\b)"
_ON = r"(?:enable|activate|allow|permit|turn\s+on|switch\s+on|unblock|aktivieren|aktiviere|einschalten|erlauben|active|activar|habilite|habilitar|permita|activez|activer|autorisez)"
_READER = r"(?:view|see|read|show|open|use|load|continue|proceed|display|access|browse|work|run)"

#: (weight, pattern) of each family: what is said. Every feature counts once in a sentence (fixed values).
SAID: dict[str, list[tuple[float, str]]] = {
    "error_page": [
        (2.0, r"\b" + _THING + r"\s+(?:(?:that\s+)?you\s+(?:are\s+looking\s+for|requested|asked\s+for|wanted|tried\s+to\s+\w+)\s+|(?:que|die|qui)\s+\w+(?:\s+\w+){0,2}?,?\s+)?(?:\([^()]{1,40}\)\s+)?" + _FAILED),
        (1.0, r"\b" + _FAILED),
        (2.0, r"^\W*" + _REASON + r"\s*(?:[.!:(|–—-]|$)"),
        (2.0, r"^\W*(?:http\s+|fehler\s+|erreur\s+)?[45]\d\d\s*[.:–—|-]?\s*" + _REASON),
        (2.0, r"^\W*(?:http|error|status|code|fehler|fehlercode|erreur|código|codigo)\s*(?:code\s*)?[:#]?\s*[1-5]\d\d\b"),
        (2.0, r"\(\s*(?:http|error|status|code|fehler|erreur)\s*:?\s*[1-5]\d\d\s*\)|\bhttp(?:/\d(?:\.\d)?)?\s+[45]\d\d\b|\b[45]\d\d\s*[:–—-]?\s*" + _REASON),
        (3.0, r"^\W*(?:fatal(?:\s+error)?|critical|panic|uncaught\s+\w+)\s*:\s*\S"),
        (2.0, r"^\W*(?:exception|error|fehler|erreur)\s*:\s*\S"),
        (3.0, r"\btraceback\s*\(most\s+recent\s+call\s+last\)|^\W*at\s+[\w$.]+\([\w$]+\.\w+:\d+\)|^\W*file\s+\"[^\"]+\",\s+line\s+\d+"),
        (2.0, r"^\W*(?:\w+\.)*[A-Z][A-Za-z]*(?:Error|Exception|Fault)\s*[:(]\s*\S"),
        (2.0, r"\bstack\s*trace\s*:"),
        (2.0, r"^\W*(?:request|access|connection|session|login|page|file|document|upload|download)\s+(?:was\s+)?(?:blocked|denied|refused|rejected|expired|timed\s+out|reset|failed|unavailable|not\s+found)\b"),
        (2.0, r"^\W*(?:(?:we\s+(?:are|were)\s+)?unable\s+to|failed\s+to|cannot|could\s+not|can'?t|couldn'?t)\s+(?:load|open|display|show|render|connect|reach|find|process|retrieve)\b"),
        (2.0, r"\b(?:you\s+(?:lack|do\s+not\s+have|don'?t\s+have|are\s+not\s+(?:allowed|authori[sz]ed|permitted)))\b.{0,40}\b(?:rights?|permissions?|access|privileges?|view|see|open|read)\b"),
        (1.0, r"^\W*(?:we\s+are\s+(?:very\s+)?sorry|we'?re\s+sorry|sorry|oops|alas|hmm+|uh[- ]?oh|whoops|apologies|unfortunately|leider|entschuldigung|lo\s+sentimos|désolé)\b"),
        (1.0, r"^\W*(?:oh|notice|problem|warning|attention|achtung|aviso)\s*[,:;!–—-]"),
        (0.75, r"^\W*(?:please\s+|bitte\s+)?(?:try\s+again|retry|reload|refresh|go\s+back|return\s+to|check\s+the\s+(?:spelling|address|url|link)|contact\s+(?:the|your|our)\s+(?:\w+\s+)?(?:administrator|webmaster|support|operator)|tell\s+the\s+(?:webmaster|administrator|operator)|sign\s+in|log\s+in|slow\s+down|versuchen\s+sie|inténtelo|réessayez)\b"),
        (1.0, r"\b(?:something\s+(?:broke|went\s+wrong)|on\s+our\s+(?:side|end)|for\s+(?:planned|scheduled)\s+(?:upkeep|maintenance)|ticket\s+\w*\d\w*|(?:event|incident|request)\s+(?:id\s+)?\w*\d\w*|exhausted|etwas\s+ist\s+schief|algo\s+salió\s+mal)\b"),
    ],
    "script_notice": [
        (0.5, _JS),
        (1.5, r"\b(?:is|are|seems?\s+to\s+be|appears?\s+to\s+be|stays?|remains?)\s+(?:required|needed|necessary|disabled|deactivated|off|blocked|turned\s+off|switched\s+off|not\s+(?:enabled|supported|available|active|allowed))\b"),
        (1.5, _JS + r"\s+(?:must|has\s+to|have\s+to|needs?\s+to|should)\s+be\s+(?:on|enabled|active|activated|allowed|turned\s+on|switched\s+on)\b"),
        (1.5, r"\b(?:without|ohne|sin|sans)\s+" + _JS + r".{0,100}\b(?:cannot|can\s*not|can'?t|will\s+not|won'?t|does\s+not|doesn'?t|nothing|only|nicht|no\s+(?:se\s+)?puede|ne\s+peut)\b"),
        (1.5, r"\b(?:needs?|requires?|benötigt|erfordert|necesita|requiere|nécessite)\s+(?:cookies\s+and\s+)?" + _JS),
        (1.5, r"\b" + _ON + r"\s+(?:sie\s+|the\s+)?(?:use\s+of\s+)?(?:\w+\s+)?" + _JS + r"|\b(?:turn|switch)\s+" + _JS + r"\s+on\b|" + _JS + r".{0,30}\b(?:aktivieren|einschalten|erlauben|zulassen)\b"),
        (1.5, r"\b(?:browser|device|reader|client|navegador|navigateur)\b.{0,20}\b(?:does\s+not|doesn'?t|cannot|can'?t|will\s+not|is\s+not|no|ne)\s+(?:run|support|allow|execute|accept|have|allowing|running|unterstützt|admite|prend)\b|\bbrowser\s+unterstützt\s+kein"),
        (1.5, r"\b(?:browser|device|reader)\s+(?:is\s+(?:too\s+old|outdated)|blocks?|has\s+(?:disabled|blocked))\b"),
        (1.5, r"\b(?:off|disabled|blocked|deaktiviert|desactivado|désactivé)\s*(?:[.!;,]|$)|\b(?:desactivado|deaktiviert|désactivé)\b"),
        (2.0, r"\bno-?script\b|</?noscript>"),
        (2.0, r"\b(?:checking|verifying)\s+(?:your\s+(?:browser|connection|device)|(?:that\s+)?you\s+are\s+(?:a\s+)?human)\b"),
        (0.5, r"\b(?:to\s+(?:be\s+)?" + _READER + r"|and\s+(?:reload|refresh|try)|um\s+.{1,60}\s+zu\s+\w+|para\s+(?:ver|usar|continuar|leer)|pour\s+(?:voir|utiliser|continuer|lire))\b"),
        (1.0, r"^\W*(?:please|bitte|por\s+favor|veuillez)\s+.{0,30}\b(?:it|them|this|sie|es|lo)\s+(?:on\s+)?(?:to|in|and)\b"),
        (0.5, r"\b(?:cookies|nothing\s+can\s+be|cannot\s+start|only\s+this\s+message)\b"),
    ],
    "filler": [
        (2.0, r"\b(?:text|words?|wording|content|copy|heading|title|summary|description)\s+(?:goes?|comes?|belongs?|will\s+(?:go|come|appear))\s+(?:in\s+)?here\b|\b(?:hier\s+steht\s+(?:ihr|dein|der)\s+text|aquí\s+va\s+(?:el|su)\s+texto|votre\s+texte\s+ici)\b"),
        (2.0, r"^\W*(?:your|the|some)\s+(?:text|words?|wording|content|copy|title|heading)\s+(?:in|on|at)?\s*(?:this\s+(?:spot|place|space|block|box|section|field)|here)\b"),
        (2.0, r"^\W*(?:click|tap|double-?click)\s+(?:here\s+)?to\s+(?:edit|add|change|replace|enter)\b"),
        (2.0, r"^\W*(?:please\s+)?(?:replace|swap|overwrite|delete)\s+this\s+(?:\w+\s+)?(?:paragraph|text|block|section|sentence|copy|wording|content)\b"),
        (2.0, r"^\W*(?:please\s+)?(?:write|say|add|put|enter)\s+(?:something|a\s+few\s+words|some\s+(?:words|text)|a\s+sentence|your\s+text)\s+(?:about\b.*\bhere|on\b.*\bhere|here)\b"),
        (1.0, r"\b(?:dummy|filler|placeholder|blind|sample|example|body)\s+(?:copy|text|content|wording|paragraph|sentence|words)\b"),
        (1.0, r"\b(?:for\s+(?:layout|design|position)|goes\s+here|only\s*[.!]?$|body\s+text\s*[.!]?$)"),
        (1.0, r"^\W*(?:this\s+is\s+(?:only\s+|just\s+)?(?:a\s+|some\s+)?)?(?:dummy|filler|placeholder|blind|sample|example|body|some|more|main)\s+(?:copy|text|content|wording|paragraph|sentence|words|headline)(?:\s+(?:body|some|more|main)\s+text)?\W*$"),
        (1.0, r"^\W*(?:body|some|more|main)\s+text\s+(?:body|some|more|main)\s+text\b"),
        (1.0, r"\bthis\s+(?:block|paragraph|text|section|copy|box)\s+(?:is\s+(?:here\s+)?)?(?:only|just|merely)\b"),
        (1.0, r"\b(?:shows?|demonstrates?|illustrates?|to\s+show|to\s+see)\s+how\s+the\s+(?:page|layout|design|text|column)\b"),
        (1.0, r"\b(?:the\s+)?(?:real|final|actual|proper)\s+(?:wording|text|copy|content|words)\b"),
        (1.0, r"^\W*(?:please\s+)?(?:swap|put|drop|paste|fill|add|insert|write)\s+in\b|\blater\s*[.!]?$"),
        (1.0, r"\b(?:text|wording|copy|content|paragraph|section|description)\s+(?:is\s+)?(?:to\s+follow|coming\s+soon|to\s+be\s+(?:supplied|written|added|provided))\b"),
        (1.0, r"\b(?:not\s+yet|yet\s+to|still\s+to|has\s+not)\s+(?:been\s+)?(?:suppl|provid|writ|deliver)\w*"),
        (1.0, r"\b(?:the|its|their)\s+(?:wording|copy|text|content)\s+(?:for|of)\b|\b(?:wording|text|copy|content)\s*(?:later|soon)?\s*[.!]?$"),
        (1.0, r"\b(?:coming\s+soon|to\s+follow|to\s+come)\s*[.!]?$"),
    ],
}
#: To whom and how, alike for messages and notices: a reader who is addressed, and this place (fixed values).
_READERS = re.compile(r"\b(?:you|your|we|our|us|please|this\s+(?:page|site|viewer|reader|application|app|service|message|document|library)|the\s+requested|ihr|ihre[nrs]?|sie|bitte|diese\s+seite|usted|su|por\s+favor|esta\s+página|vous|votre|veuillez|cette\s+page)\b", re.I)
#: A condition or a rule speaks of what may happen, an explanation or a report of somebody else (fixed values).
_CONDITION = re.compile(r"\b(?:if|when|whenever|unless|whether|in\s+case|wenn|falls|sobald|cuando|siempre\s+que|lorsque|quand)\b", re.I)
_EXPLAINS = re.compile(r"\b(?:means|denotes|indicates|signals|stands\s+for|refers?\s+to|is\s+(?:called|known\s+as|defined|raised|returned|sent)|are\s+(?:called|raised|returned|sent)|raises|throws|returns|catches|describes|explains|defines|bedeutet|bezeichnet|heißt|significa|indica|signifie|désigne|such\s+as|for\s+example|history|century|(?:since|in)\s+(?:the\s+)?1\d{3}s?)\b", re.I)
_OTHERS = re.compile(r"\b(?:the|an?|each|every|any|all)\s+(?:\w+\s+){0,2}?(?:user|visitor|tester|team|manager|desk|staff|operator|member|owner|customer|client|author|engineer|employee|administrator|holder|auditor|reviewer)s?\s+(?:who\b|that\b|must\b|should\b|may\b|will\b|can\b|at\b|\w+(?:s|ed)\b)|^\W*(?:staff|users|visitors|sessions|testers|people)\b", re.I)
_RULE = re.compile(r"\b(?:must|should|shall|may|soll(?:te)?|muss|debe|doit)\b", re.I)
#: A sentence is residue from this score on; a neighbour that scores helps by half of its score.
LEAST = 2.0

# Exception names are told by their capitals.
_SAID = {family: [(w, re.compile(p, 0 if "Exception|Fault" in p else re.I)) for w, p in features] for family, features in SAID.items()}


def sentence_score(family: str, sentence: str, alone: bool) -> float:
    """How much speaks for a sentence being residue of the family; `alone` if it is a line or a text of its own."""
    score = 0.0
    for weight, pattern in _SAID[family]:
        if pattern.search(sentence):
            if weight >= 3.0:
                # What only a machine writes needs no further look.
                return weight
            score += weight
    if score <= 0.0:
        return 0.0
    if family == "filler":
        # Stopgaps stand for themselves; what is told of them names a place, a time or somebody.
        return score - (1.0 if _EXPLAINS.search(sentence) else 0.0) - (0.5 if len(sentence.split()) > 14 else 0.0)
    to_reader = bool(_READERS.search(sentence))
    if to_reader:
        score += 0.5
    if _EXPLAINS.search(sentence):
        score -= 3.0 if not to_reader else 1.0
    if _OTHERS.search(sentence):
        score -= 2.0
    condition = _CONDITION.search(sentence)
    if condition:
        # "Try again when ..." tells a reader what to do now; "When a page is not found, ..." does not.
        score -= 0.5 if to_reader or condition.start() > 0.6 * len(sentence) else 2.0
    if _RULE.search(sentence) and not to_reader and family == "error_page":
        score -= 1.0
    if alone:
        score += 0.5
    elif family == "script_notice" and not to_reader:
        score -= 0.25
    return score


def _each(*parts: str) -> list[str]:
    """Every way to put together one choice of each part."""
    out = [""]
    for part in parts:
        out = [x + choice for x in out for choice in part.split("|")]
    return out


_STOPGAPS = "text|word|wording|content|copy|title|heading|summary|description"
#: Words without which no sentence of the family scores enough.
CUES: dict[str, list[str]] = {
    "error_page": [
        *"not found|not be |n't be|not available|unavailable|inaccessible|unreachable|not accessible|not reachable|longer exist|longer available|not exist|n't exist|offline|is down|are down|was down|is gone|are gone|is missing|failed to|too long|timed out|time-out|timeout|expired|run out|no answer|no data|no reply|no response|not respond|not answer|not load|not start|not reach|not open|not connect|only open|forbidden|bad gateway|bad request|denied|internal fault|internal error|internal server|server error|too many requests|unauthorized.|unauthorised.|unauthorized:|unauthorized\n|refused|request blocked|request was|request rejected|rejected by|access blocked|http|fatal|critical:|panic:|uncaught|exception:|exception(|traceback|stack trace|stacktrace|.java:|file \"|fault:|error(|unable to|cannot load|cannot open|cannot display|cannot show|cannot find|cannot connect|cannot reach|could not load|could not find|can't |couldn't |you lack|you do not|you don't|you are not|you requested|you asked|you are looking|sorry|oops|whoops|alas|went wrong|broke on|exhausted|nicht ge|nicht er|nicht ver|nicht an|nicht mehr|abgelaufen|fehler|verweigert|encontr|denegado|no est|no existe|caducado|introuvable|indisponible|refus|erreur|n'existe|n'a pas|expir".split("|"),
        *_each("error|status|code", " 1| 2| 3| 4| 5|: |:1|:2|:3|:4|:5| #"), *_each("been |has |have ", "taken off|moved|removed|deleted|renamed|withdrawn|ended|closed|timed"),
    ],
    "script_notice": "script|js|active content|aktive inhalte|skript|browser|you are human|you are a human|navegador|navigateur".split("|"),
    "filler": [
        *_each("go|goes|come|comes|belong|belongs|appear", " here| in here"), *_each(_STOPGAPS, " here|s here| in this| on this| at this|s in this| to follow| coming soon| to be suppl| to be writ| to be prov| to be added"),
        *_each("in |on |at ", "this ", "spot|place|space|block|box|section|field"), *_each("click |tap |double-click |click here |tap here ", "to "), *_each("replace|swap|overwrite|delete", " this "), *_each("dummy|filler|placeholder|blind|sample|example|body|some|more|main", " ", "copy|text|content|wording|paragraph|sentence|words|headline"),
        *_each("how the ", "page|layout|design|text|column"), *_each("real|final|actual|proper", " ", "wording|text|copy|content|words"), *_each("not yet |yet to |still to |has not |not been |yet been ", "suppl|provid|writ|deliver|been suppl|been prov|been writ|been deli"), "something about", "something here", "few words", "some words", "a sentence", "your text", "aquí va", "texte ici", "hier steht",
    ],
}
_KEYBOARD, _FAMILY_NAMES = -1, tuple(SAID)


def _cue_automaton() -> ahocorasick.Automaton:
    by_cue: dict[str, set[int]] = {}
    for number, family in enumerate(_FAMILY_NAMES):
        for cue in CUES[family]:
            by_cue.setdefault(cue, set()).add(number)
    for cue in _KEY_STARTS:
        by_cue.setdefault(cue, set()).add(_KEYBOARD)
    automaton = ahocorasick.Automaton()
    for cue, numbers in by_cue.items():
        automaton.add_word(cue, tuple(numbers))
    automaton.make_automaton()
    return automaton


_CUES = _cue_automaton()
_BREAK = re.compile(r"(?<=[.!?;])[\"'”’)]*\s+|\n+|(?<=\|)\s+(?=[A-Z])")
_SPACES = re.compile(r" {2,}|[ \t\u00a0]*[\t\u00a0][ \t\u00a0]*")
#: A line that ends within a sentence goes on in the next one; a capital may also begin a new one after a heading.
_WRAP = re.compile(r"(?<=[^\n.!?:])\n(?=[^\n])")


def _views(lines: str) -> tuple[str, ...]:
    """The text with all its wrapped lines joined, and with those apart that begin with a capital."""
    flat = _WRAP.sub(" ", lines)
    apart = _WRAP.sub(lambda m: "\n" if lines[m.end()].isupper() else " ", lines) if flat != lines else flat
    return (flat,) if apart == flat else (flat, apart)


def _messages(flat: str, wanted: set[int], hits: list[tuple[int, tuple[int, ...]]]) -> Iterator[tuple[str, str]]:
    """The families with a sentence that scores enough, judged with its neighbours."""
    starts = [0]
    for m in _BREAK.finditer(flat):
        starts.append(m.end())
    ends = [*starts[1:], len(flat)]
    asked: dict[int, set[int]] = {}
    for end, numbers in hits:
        place = bisect_right(starts, end) - 1
        for number in numbers:
            if number in wanted:
                asked.setdefault(number, set()).add(place)
    for number, places in sorted(asked.items()):
        family = _FAMILY_NAMES[number]
        scores: dict[int, float] = {}

        def score(k: int) -> float:
            if not 0 <= k < len(starts):
                return 0.0
            if k not in scores:
                sentence = flat[starts[k] : ends[k]].strip()
                alone = (starts[k] == 0 or flat[starts[k] - 1] == "\n") and (ends[k] == len(flat) or flat[ends[k] - 1] == "\n")
                scores[k] = sentence_score(family, sentence, alone) if sentence else 0.0
            return scores[k]

        for k in sorted(places):
            mine = score(k)
            if mine > 0 and (mine >= LEAST or mine + 0.5 * max(score(k - 1), score(k + 1), 0.0) >= LEAST and mine >= 1.0):
                yield family, flat[starts[k] : ends[k]].strip()[:80]
                break


def judge(text: str) -> list[tuple[str, str]]:
    """The kinds of residue in a text: (kind, what showed it)."""
    views = _views(_SPACES.sub(" ", text))
    low = views[0].lower()
    found: dict[str, str] = {}
    if kind := _placeholder(text):
        found["placeholder"] = kind
    hits = list(_CUES.iter(low))
    possible = {n for _, numbers in hits for n in numbers}
    if kind := ("keyboard" if _KEYBOARD in possible and _keyboard(low) else _senseless(low)):
        found["filler"] = kind
    # Views have equal lengths, so a cue stands at one place in both; only where lower-casing changes the length it is
    # looked for in the text with such characters left as they are.
    if len(low) != len(views[0]):
        hits = list(_CUES.iter("".join(c.lower() if len(c.lower()) == 1 else c for c in views[0])))
    for view in views:
        wanted = {n for n in possible if n != _KEYBOARD and _FAMILY_NAMES[n] not in found}
        if wanted:
            for family, sign in _messages(view, wanted, hits):
                found.setdefault(family, sign)
    return list(found.items())


VERDICT = "row_no bigint, kinds array<string>, signs array<string>"


def residue(chunks: DataFrame, text: str = "text", key: str = "row_no") -> DataFrame:
    """One row for each chunk that holds residue: its key, the kinds found and what showed each.

    Kinds: placeholder, filler, error_page, script_notice. Null, empty and blank texts hold none; repeated rows are
    judged alike and kept apart by their key; other columns are ignored. Texts are judged whole, however long.
    """

    def start():
        def decide(row_no: int, body: str) -> list[tuple]:
            found = judge(body)
            return [(row_no, [k for k, _ in found], [s for _, s in found])] if found else []

        return decide

    rows = chunks.select(F.col(key).cast("bigint").alias("row_no"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    return map_rows(rows, VERDICT, start)


def without_residue(chunks: DataFrame, text: str = "text") -> DataFrame:
    """The chunks free of residue, with all their columns. Rows are judged and passed on by the same task, so nothing is
    shuffled, and rows without a key or with a repeated one are kept or left out each for itself."""
    place = chunks.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([t is None or not judge(t) for t in batch.column(place).to_pylist()], pa.bool_()))

    return chunks.mapInArrow(run, chunks.schema)
