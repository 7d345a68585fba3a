"""Java regular expressions of the page rules, composed from word lists.

Character classes are spelled out so that they mean the same on every JDK: S is Unicode white space, W a word
character, NB "no word character follows".  All rule patterns ignore case, umlauts included.
"""

from __future__ import annotations

S = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NS = r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: White space within a line.
H = r"[\t \x1f\xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"
#: The characters of S, for trim and translate.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
W = r"[\p{L}\p{N}_]"
NB = rf"(?!{W})"
PB = rf"(?<!{W})"
EDGE = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
I = "(?iud)"  # noqa: E741
IM = "(?iudm)"

# Word lists and formats of the rules.
NAMESPACES = ("Datei", "File", "Image", "Kategorie", "Category", "Vorlage", "Template", "Hilfe", "Help", "Portal", "Wikipedia", "Spezial", "Diskussion", "Talk", "Benutzer", "User", "Medium", "MediaWiki", "Modul", "Module")
LINK_NAMESPACES = (*NAMESPACES, "Abbildung", "Bild")
LIST_HEADS = ("Liste", "Verzeichnis", "Übersicht", "Index")
LIST_LINKS = ("von", "der", "des", "den", "dem")
QUALITY_TEMPLATES = ("werbung", "ad", "advertisement", "promotion", "promotional", "pr", "glaskugel", "glaskugel2", "recentism", "recentismus", "aktueller event", "kurzlebig", "zeitgeist")
MONTHS = ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember")
EPISODE_WORDS = ("folge", "staffel", "episode", "kapitel", "teil")
PROMO_TITLES = ("reality-?show-?teilnehmer(?:in)?", "reality-?star", "reality-?tv-?star", "webvideoproduzent(?:in)?", "influencer(?:in)?", "keyaccounter", "tokio hotel", "playmate", "gogo-?tänzer(?:in)?", "escort", "internetphänomen", "meme")
PROMO_ROLES = ("reality-?show-?teilnehmer(?:in)?", "reality-?star", "webvideoproduzent(?:in)?", "influencer(?:in)?", "tiktoker(?:in)?", "streamer(?:in)?", "sänger(?:in)?", "band", "musiker(?:in)?", "schauspieler(?:in)?", "modell", "model", "tänzer(?:in)?", "synchronsprecher(?:in)?", "rapper(?:in)?")
PROMO_CATEGORIES = ("reality-?show-?teilnehmer", "reality-?tv-?teilnehmer", "reality-?show-?kandidat", rf"teilnehmer{S}+einer{S}+reality-?show", rf"big(?:{S}|[_-])*brother", "dschungelcamp", "internetphänomen", "webvideoproduzent")
FICTION_SCOPES = ("figur", "figuren", "personen?", "charaktere?", "orte?", "schauplätze?", "handlung", "welten?", "universum")
FICTION_CATEGORIES = ("fernsehserien-?episode", "episodenliste", rf"figur{S}+(?:in|aus)", rf"figuren{S}+(?:in|aus)", rf"personen?{S}+(?:in|aus)")
APPENDICES = ("einzelnachweise", "literatur", "weblinks", "siehe auch")


def any_of(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


def template(names: str, close: str = r"(?:\||\}\})") -> str:
    return rf"\{{\{{{S}*{names}{S}*{close}"


def category(names: str) -> str:
    return rf"\[\[{S}*(?:Kategorie|Category){S}*:[^\]]*{names}[^\]]*\]\]"


# The formats that the rules look for; a rule's result is what its format matches.
NAMESPACE_TITLE = rf"{I}^{any_of(NAMESPACES)}:"
LIST_TITLE = rf"{I}^{any_of(LIST_HEADS)}{S}+{any_of(LIST_LINKS)}{NB}"
REDIRECT = rf"{I}^{S}*#{S}*(?:redirect|weiterleitung){NB}"
REDIRECT_TARGET = rf"{I}^{S}*#{S}*(?:redirect|weiterleitung){NB}[^\[]*\[\[([^\]|#]+)"
DISAMBIGUATION = rf"{I}\[\[{S}*(?:Kategorie|Category){S}*:{S}*Begriffsklärung"
STUB = I + template("(?:substub|stub)")
QUALITY = I + template(any_of(QUALITY_TEMPLATES))
OUTLOOK = rf"{IM}^[ \t]*" + template(r"(?:zukunftsmusik|zukunft\p{Nd}?)")
OUTDATED = I + template("veraltet")
CITE_START = rf"{I}\{{\{{{S}*(?:belege{S}*fehlen|belegt{S}*nicht){S}*[|}}]"
OLD_FILTER = I + template(any_of((*QUALITY_TEMPLATES, "belege fehlen", "belegt nicht")))
PROMO_CATEGORY = I + category(any_of(PROMO_CATEGORIES))
PROMO_TITLE = rf"{I}\({any_of(PROMO_TITLES)}\)$"
PROMO_TITLE_YEAR = rf"{I}\({any_of(PROMO_ROLES)},{S}*\*(?:19[5-9]\p{{Nd}}|20[01]\p{{Nd}})\)$"
YEAR_TITLE = rf"(?d)^\p{{Nd}}{{1,4}}(?:{S}+v\.{S}*Chr\.)?$"
DATE_TITLE = rf"{I}^(?:\p{{Nd}}{{1,2}}\.{S}+{any_of(MONTHS)}|\p{{Nd}}{{1,2}}\.{S}+jahrhundert(?:{S}+v\.{S}*chr\.?)?)$"
EPISODE_TITLE = rf"{I}(?:{PB}{any_of(EPISODE_WORDS)}{S}+\p{{Nd}}+{NB}|{PB}\p{{Nd}}+\.{S}*{any_of(EPISODE_WORDS)}{NB}|{PB}(?:folgen?|staffeln?|episoden)liste{NB}|\(episode\))"
DELETION = I + template("(?:sla|löschantrag(?:stext)?|urv)", r"[|}]")
DISGUISED = rf"{I}^[^\n]{{0,150}}{PB}steht für{S}*:"
FICTION_TITLE = rf"{I}\({any_of(FICTION_SCOPES)}\)$"
FICTION_CATEGORY = I + category(any_of(FICTION_CATEGORIES))
TAXON = I + template("taxobox", r"[|}]")
LINK_NAMESPACE = rf"{I}^{any_of(LINK_NAMESPACES)}:"
WIKILINK = r"\[\[([^\[\]]+)\]\]"
#: A link's target up to a label or a fragment; none with a colon, none that is empty.
LINK_TARGET = rf"\[\[{S}*+([^\[\]|#:]++)(?:[|#][^\[\]]*+)?\]\]"
#: A link with a target that names no namespace; colons before it don't count.
CONTENT_LINK = rf"{I}\[\[{S}*+:*+{S}*+(?=[^\[\]|])(?!{any_of(LINK_NAMESPACES)}:)[^\[\]]++\]\]"

# The sanitizer's steps in their order, up to the appendix step: (name, pattern, replacement).
BEFORE_ENTITIES = (("comments", r"(?s)<!--.*?-->", ""),)
_PAIR = rf"\p{{Nd}}{{1,3}}{S}*°{S}*\p{{Nd}}{{1,2}}(?:[.,]\p{{Nd}}+)?{S}*[′']?(?:{S}*\p{{Nd}}{{1,2}}(?:[.,]\p{{Nd}}+)?{S}*[″\"]?)?{S}*"
_DEGREE = rf"\p{{Nd}}{{1,3}}(?:[.,]\p{{Nd}}+)?{S}*°{S}*"
STEPS = (
    ("image_links", rf"{I}\[\[(?:Datei|File|Image|Abbildung|Bild):[^\]]*\]\]", ""),
    ("category_links", rf"{I}\[\[(?:Kategorie|Category):[^\]]*\]\]", ""),
    ("refs", rf"(?is)<ref[^>/]*>.*?</ref{S}*>", ""),
    ("self_refs", r"(?i)<ref[^>]*/>", ""),
    ("templates", r"\{\{(?:[^{}]++|\{[^{}]*+\})*+\}\}", ""),
    ("tags", r"</?[a-zA-Z][^>]*>", ""),
    ("wikilinks", r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", "$1"),
    ("url_url_links", rf"\[(?:https?|ftp)://{NS}+{S}+(?:https?|ftp)://{NS}+\]", ""),
    ("url_links", rf"\[(?:https?|ftp)://{NS}+{S}+((?!(?:https?|ftp)://)[^\]]+)\]", "$1"),
    ("bare_links", rf"\[(?:https?|ftp)://{NS}+\]", ""),
    ("urls", rf"(?=[hf])(?<![\p{{L}}\p{{N}}_\"])(?:https?|ftp)://{NS}+", ""),
    ("bold", r"'{2,5}", ""),
    ("tables", r"(?dms)^\{\|.*?\|\}$", ""),
    ("pipe_lines", r"(?dm)^[ \t]*\|+[ \t]*$", ""),
    ("row_breaks", r"(?dm)^[ \t]*\|-+.*$", ""),
    ("leading_pipes", r"(?dm)^[ \t]*\|+[ \t]*", ""),
    ("trailing_pipes", r"(?dm)[ \t]*\|+[ \t]*$", ""),
    ("inner_pipes", r"\|+", " "),
    ("phonetics", r"\[[^\[\]\n]{0,120}?[ˈˌ][^\[\]\n]{0,120}?\]", " "),
    ("coordinate_templates", rf"{I}\{{\{{{S}*(?:koordinate|coordinate|coord)[^{{}}]*+(?:\{{[^{{}}]*+\}}[^{{}}]*+)*+\}}\}}", ""),
    ("coordinates", rf"(?=\p{{Nd}}){PB}(?:{_PAIR}[NS]?(?:{S}*[,;/]{S}*|{S}+){_PAIR}[OEW]?{EDGE}|{_DEGREE}[NS]{S}*[,;/]?{S}*{_DEGREE}[EOW]{NB})", " "),
)
LINE_ENDS = "".join(map(chr, (13, 11, 12, 28, 29, 30, 0x85, 0x2028, 0x2029)))
HEADING = rf"^{H}*(={{2,6}}){H}*(.*?){H}*\1{H}*$"
