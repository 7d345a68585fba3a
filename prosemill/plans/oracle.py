"""DuckDB SQL for the registered queries, over the same adapter; regular expressions are RE2, without lookaround."""

from __future__ import annotations

from ..functions import patterns as P
from ..options import DEFAULT
from .adapter import pages_sql
from .queries import DEMO_EXTRA, DEMO_TITLES, MISSPELLED, SMALL, TERM

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WS = r"[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
END = r"(?:[^\p{L}\p{N}_]|$)"
START = r"(?:^|[^\p{L}\p{N}_])"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def hit(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {lit('(?i)' + pattern)})"


def sub(expression: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expression}, {lit(pattern)}, {lit(by)}, {lit(flags)})"


def strip(expression: str) -> str:
    return sub(expression, f"^{WS}+|{WS}+$")




def one_of(words: tuple[str, ...]) -> str:
    """The rules' word lists, with white space as this dialect has it."""
    return "(" + "|".join(w.replace(P.S, r"\s") for w in words) + ")"


NAMES = one_of(P.NAMESPACES)
PAGES = f"src AS ({pages_sql('documents')}), pages AS (SELECT page_id, part, {strip('title')} AS title, raw FROM src)"
#: The adapter's banners are never nested, so their scope can be read off with patterns: bare and before any heading, or
#: with a scope that names the whole article.
BANNER = r"\{\{(?:Belege fehlen|Belegt nicht)\}\}"
WHOLE = hit("raw", r"\{\{Belege fehlen\|x\|2=(Dieser Artikel|Der ganze Text)\}\}")
CITES = f"((regexp_matches(raw, {lit(BANNER)}) AND NOT regexp_matches(regexp_extract(raw, {lit('(?s)^(.*?)' + BANNER)}, 1), {lit('(?m)^={2,6}')})) OR {WHOLE})"
QUALITY = hit("raw", r"\{\{\s*" + one_of(P.QUALITY_TEMPLATES) + r"\s*(\||\}\})")
OUTLOOK = "regexp_matches(raw, " + lit(r"(?im)^[ \t]*\{\{\s*(zukunftsmusik|zukunft\d?)\s*(\||\}\})") + ")"
OLD = hit("raw", r"\{\{\s*veraltet\s*(\||\}\})")
RULES = {
    "f01_empty_title": ("empty-title", "title = ''"),
    "f02_namespace_title": ("namespace-title", hit("title", f"^{NAMES}:")),
    "f03_list_title": ("list-article", hit("title", f"^{one_of(P.LIST_HEADS)}{WS}+{one_of(P.LIST_LINKS)}" + END)),
    "f04_redirect": ("redirect", hit("raw", r"^\s*#\s*(redirect|weiterleitung)" + END)),
    "f05_disambiguation": ("disambiguation", hit("raw", r"\[\[\s*(Kategorie|Category)\s*:\s*Begriffsklärung")),
    "f06_stub": ("stub", hit("raw", r"\{\{\s*(substub|stub)\s*(\||\}\})")),
    "f07_quality_template": ("quality-template", f"(({QUALITY} OR {OUTLOOK} OR {CITES}) AND NOT {OLD})"),
    "f08_promo_category": ("promo-category", hit("raw", r"\[\[\s*(Kategorie|Category)\s*:[^\]]*" + one_of(P.PROMO_CATEGORIES) + r"[^\]]*\]\]")),
    "f09_promo_title": ("promo-title", f"({hit('title', r'\(' + one_of(P.PROMO_TITLES) + r'\)$')} OR {hit('title', r'\(' + one_of(P.PROMO_ROLES) + r',\s*\*(19[5-9]\d|20[01]\d)\)$')})"),
    "f10_year_title": ("year-title", hit("title", r"^\d{1,4}(\s+v\.\s*Chr\.)?$")),
    "f11_date_title": ("date-title", f"({hit('title', r'^\d{1,2}\.\s+' + one_of(P.MONTHS) + '$')} OR {hit('title', r'^\d{1,2}\.\s+jahrhundert(\s+v\.\s*chr\.?)?$')})"),
    "f12_episode_title": ("episode-title", f"({hit('title', START + one_of(P.EPISODE_WORDS) + r'\s+\d+' + END)} OR {hit('title', START + r'\d+\.\s*' + one_of(P.EPISODE_WORDS) + END)} OR {hit('title', START + r'(folgen?|staffeln?|episoden)liste' + END)} OR {hit('title', r'\(episode\)')})"),
    "f13_deletion_banner": ("deletion-banner", hit("raw", r"\{\{\s*(sla|löschantrag(stext)?|urv)\s*[|}]")),
}
REASON = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, c in RULES.values()) + " END"

COORDINATE = r"\d{1,3}\s*°\s*\d{1,2}(?:[.,]\d+)?\s*[′']?(?:\s*\d{1,2}(?:[.,]\d+)?\s*[″\"]?)?\s*"
STEPS = {
    "comments": [(r"<!--(?:.|\n)*?-->", "")],
    "media": [(r"(?i)\[\[(Datei|File|Image|Abbildung|Bild):[^\]]*\]\]", ""), (r"(?i)\[\[(Kategorie|Category):[^\]]*\]\]", "")],
    "refs": [(r"(?is)<ref[^>/]*>.*?</ref\s*>", ""), (r"(?i)<ref[^>]*/>", "")],
    "templates": [(r"\{\{(?:[^{}]|\{[^{}]*\})*\}\}", "")],
    "tags": [(r"</?[a-zA-Z][^>]*>", "")],
    "wikilinks": [(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", r"\1")],
    "urls": [(r"\[(?:https?|ftp)://\S+\s+(?:https?|ftp)://\S+\]", ""), (r"\[(?:https?|ftp)://\S+\s+([^\]]+)\]", r"\1"), (r"\[(?:https?|ftp)://\S+\]", ""), (r"(^|[^\p{L}\p{N}_\"])(?:https?|ftp)://\S+", r"\1")],
    "bold": [(r"'{2,5}", "")],
    "tables": [(r"(?ms)^\{\|.*?\|\}$", "")],
    "pipes": [(r"(?m)^[ \t]*\|+[ \t]*$", ""), (r"(?m)^[ \t]*\|-+.*$", ""), (r"(?m)^[ \t]*\|+[ \t]*", ""), (r"(?m)[ \t]*\|+[ \t]*$", ""), (r"\|+", " ")],
    "ipa": [(r"\[[^\[\]\n]{0,120}?[ˈˌ][^\[\]\n]{0,120}?\]", " "), (r"(?i)\{\{\s*(?:koordinate|coordinate|coord)[^{}]*(?:\{[^{}]*\}[^{}]*)*\}\}", ""), (rf"(?i)\b{COORDINATE}[NS]?(?:\s*[,;/]\s*|\s+){COORDINATE}[OEW]?\b", " ")],
}


def step(expression: str, *names: str) -> str:
    for name in names:
        for pattern, by in STEPS[name]:
            expression = sub(expression, pattern, by)
    return expression


def decoded(expression: str) -> str:
    """The adapter's entities, those in entities too."""
    for name, sign in (("&amp;", "&"), ("&amp;", "&"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&#8211;", "–"), ("&#x41;", "A")):
        expression = f"replace({expression}, '{name}', '{sign}')"
    return expression


def appendix(source: str, column: str, out: str) -> str:
    """CTEs that turn source(page_id, column) into out(page_id, text): a line goes if the last heading of level 2 up to it
    is an appendix (the adapter's deeper headings are never appendices)."""
    return rf"""{out}_lines AS (SELECT page_id, unnest(string_split({column}, chr(10))) AS line, generate_subscripts(string_split({column}, chr(10)), 1) AS n FROM {source}),
    {out}_marked AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^\s*==[^=].*==\s*$') THEN lower(trim(replace(line, '=', ''))) END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY n) AS section FROM {out}_lines),
    {out} AS (SELECT s.page_id, coalesce(t.text, '') AS text FROM {source} s LEFT JOIN (SELECT page_id, string_agg(line, chr(10) ORDER BY n) AS text FROM {out}_marked WHERE coalesce(section, '') NOT IN {P.APPENDICES} GROUP BY page_id) t USING (page_id))"""


def tidy(expression: str) -> str:
    lines = f"list_transform(string_split(replace({expression}, chr(160), ' '), chr(10)), lambda x: regexp_replace({strip('x')}, '[ \\t]{{2,}}', ' ', 'g'))"
    return strip(sub(f"array_to_string({lines}, chr(10))", r"\n{2,}", "\n\n"))


FULL = step(decoded(step("raw", "comments")), "media", "refs", "templates", "tags", "wikilinks", "urls", "bold", "tables", "pipes", "ipa")
CLEAN = f"markup AS (SELECT page_id, {FULL} AS m FROM pages), {appendix('markup', 'm', 'cut')}, clean AS (SELECT page_id, {tidy('text')} AS text FROM cut)"


def words(expression: str) -> str:
    return f"len(regexp_extract_all({expression}, {lit(NOT_WS + '+')}))"


def content_links(expression: str) -> str:
    name = strip(sub(strip("split_part(x, '|', 1)"), "^:+"))
    return f"len(list_filter(regexp_extract_all({expression}, '\\[\\[([^\\[\\]]+)\\]\\]', 1), lambda x: {name} <> '' AND NOT {hit(name, f'^{one_of(P.LINK_NAMESPACES)}:')}))"


MEASURED = f"measured AS (SELECT page_id, part, title, raw, text, {words('text')} AS words, {content_links('raw')} AS links FROM pages JOIN clean USING (page_id))"
PROSE = {"f14_disguised": ("disambiguation", hit("text", r"^[^\n]{0,150}" + START + r"steht für\s*:")), "f15_too_short": ("too-short", "words < 50"), "f16_link_heavy": ("link-heavy", "links > 0.5 * words")}
AFTER = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, c in PROSE.values()) + " END"
JUDGED = f"judged AS (SELECT *, coalesce({REASON}, {AFTER}) AS reason FROM measured), accepted AS (SELECT * FROM judged WHERE reason IS NULL)"


def norm(expression: str) -> str:
    flat = sub(strip(f"replace({expression}, '_', ' ')"), f"{WS}+", " ")
    first = f"substr({flat}, 1, 1)"
    return f"(CASE WHEN {first} = 'ß' THEN 'SS' ELSE upper({first}) END || substr({flat}, 2))"


def fnv(expression: str) -> str:
    code = f"hex(encode({expression}))"
    data = f"list_transform(range(0, length({code}) // 2), lambda i: ('0x' || substr({code}, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)"
    return f"list_reduce(list_prepend(2166136261::BIGINT, {data}), lambda h, b: (xor(h, b) * 16777619) & 4294967295)"


TARGET = "regexp_extract(substr(raw, 1, 300), '(?i)^\\s*#\\s*(?:redirect|weiterleitung)(?:[^\\p{L}\\p{N}_\\[][^\\[]*)?\\[\\[([^\\]|#]+)', 1)"
GRAPH = f"""graph AS (SELECT page_id, part, title, raw, {TARGET} AS redirect FROM pages),
    occurrence AS (SELECT page_id, {norm('title')} AS source, unnest(regexp_extract_all(raw, '\\[\\[([^\\[\\]]+)\\]\\]', 1)) AS x FROM graph WHERE redirect = ''),
    named AS (SELECT page_id, source, {strip("split_part(split_part(x, '|', 1), '#', 1)")} AS t FROM occurrence WHERE {strip("split_part(x, '|', 1)")} <> ''),
    link AS (SELECT page_id, source, {norm('t')} AS target FROM named WHERE t <> '' AND NOT contains(t, ':') AND {norm('t')} <> source),
    redirect AS (SELECT source, arg_max(target, (part, page_id)) AS target FROM (SELECT part, page_id, {norm('title')} AS source, {norm('redirect')} AS target FROM graph WHERE redirect <> '') WHERE source <> '' AND target <> '' GROUP BY source),
    walk AS (SELECT source, source AS here, [source] AS seen, 0 AS hop FROM redirect UNION ALL
             SELECT w.source, r.target, list_append(w.seen, r.target), w.hop + 1 FROM walk w JOIN redirect r ON w.here = r.source WHERE w.hop < 16 AND NOT list_contains(w.seen, r.target)),
    final AS (SELECT source, arg_max(here, hop) AS final FROM walk GROUP BY source),
    ended AS (SELECT l.page_id, coalesce(f.final, l.target) AS target FROM link l LEFT JOIN final f ON l.target = f.source),
    degree AS (SELECT target, count(*) AS indegree FROM ended GROUP BY target)"""
TITLES = f"titles AS (SELECT {norm('title')} AS title, arg_min(title, (part, page_id)) AS first_title FROM pages WHERE title <> '' GROUP BY 1)"
TIER = f"""tiered AS (SELECT a.*, coalesce(d.indegree, 0) AS indegree, CASE WHEN words >= 2000 THEN 1
    WHEN {hit('title', r'\(' + one_of(P.FICTION_SCOPES) + r'\)$')} OR {hit('raw', r'\[\[\s*(Kategorie|Category)\s*:[^\]]*' + one_of(P.FICTION_CATEGORIES) + r'[^\]]*\]\]')} THEN 2
    WHEN {hit('raw', r'\{\{\s*taxobox\s*[|}]')} AND words < 150 THEN 2 WHEN NOGRAPH coalesce(d.indegree, 0) < 4 AND words < 300 THEN 2 ELSE 1 END AS tier
    FROM accepted a LEFT JOIN degree d ON {norm('a.title')} = d.target)"""
DEDUPED = "deduped AS (SELECT * FROM tiered QUALIFY row_number() OVER (PARTITION BY title ORDER BY part, page_id) = 1)"


def layout(size: int) -> str:
    return f"""placed AS (SELECT *, (row_number() OVER (PARTITION BY part ORDER BY page_id) - 1) // {size} + 1 AS local_chunk, strlen(text) AS length FROM deduped),
    laid AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY part, local_chunk ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM placed),
    store AS (SELECT row_number() OVER (ORDER BY part, page_id) AS id, title, replace(substr(text, 1, 300), chr(10), ' ') AS content_sample, dense_rank() OVER (ORDER BY part, local_chunk) AS chunk_id, "offset", length, tier, text FROM laid)"""


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ", ".join(parts) + " "


BASE = (PAGES, CLEAN, MEASURED, JUDGED)
WITH_TIERS = (*BASE, GRAPH, TIER.replace("NOGRAPH ", ""))
STORE = (*WITH_TIERS, DEDUPED, layout(SMALL.chunk_size))
TOKEN = r"[\p{L}\p{Nl}\p{No}](?:[\p{L}\p{N}_-]*[\p{L}\p{N}_])?"
FREQ = f"""said AS (SELECT title AS s, 5 AS w FROM store UNION ALL SELECT content_sample, 1 FROM store),
    token AS (SELECT unnest(regexp_extract_all(lower(s), {lit(TOKEN)})) AS word, w FROM said),
    freq AS (SELECT word, sum(w)::BIGINT AS freq FROM token WHERE length(word) BETWEEN 3 AND 28 AND NOT regexp_matches(word, '^[\\p{{Nd}}²³¹⁰⁴-⁹₀-₉①-⑨]+$') GROUP BY word)"""
VOCAB = f"vocab AS (SELECT row_number() OVER (ORDER BY freq DESC, word) - 1 AS idx, word, freq FROM freq WHERE freq >= 2 QUALIFY idx < {DEFAULT.max_words})"
DELETE = "list_distinct(list_transform(range(1, length({0}) + 1), lambda i: substr({0}, 1, i - 1) || substr({0}, i + 1)))"
DELETES = f"""v0 AS (SELECT idx, word AS variant FROM vocab), v1 AS (SELECT idx, unnest({DELETE.format('word')}) AS variant FROM vocab),
    v2 AS (SELECT v1.idx, unnest({DELETE.format('variant')}) AS variant FROM v1 WHERE idx < {DEFAULT.tier1_words}),
    variants AS (SELECT * FROM v0 UNION SELECT * FROM v1 UNION SELECT * FROM v2)"""
ASKED = "asked AS (SELECT unnest([" + ", ".join(map(lit, MISSPELLED)) + "]) AS query)"
POSTINGS = """fields AS (SELECT id, 0 AS col, lower(title) AS s FROM store UNION ALL SELECT id, 1, lower(content_sample) FROM store),
    postings AS (SELECT trigram, id, col, count(*) AS tf FROM (SELECT id, col, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) AS trigram FROM fields) GROUP BY ALL)"""
FOUND = f"found AS (SELECT id, title, tier FROM store WHERE contains(lower(title), {lit(TERM)}) OR contains(lower(content_sample), {lit(TERM)}))"
KNOWN = "known AS (SELECT DISTINCT title FROM src WHERE page_id % 2 = 0)"
OLD_RULE = hit("raw", r"\{\{\s*" + one_of((*P.QUALITY_TEMPLATES, "belege fehlen", "belegt nicht")) + r"\s*(\||\}\})")
RESCUED = f"rescued AS (SELECT a.title, words, length(raw) AS chars, k.title IS NOT NULL AS in_store FROM accepted a LEFT JOIN known k ON a.title = k.title WHERE {OLD_RULE})"


def digest(expression: str, table: str = "src", *before: str) -> str:
    return f"{with_(PAGES, *before)} SELECT page_id, length(v) AS n, md5(v) AS digest FROM (SELECT page_id, {expression} AS v FROM {table})"


SQL: dict[str, str] = {name: f"{with_(PAGES)} SELECT page_id FROM pages WHERE {c}" for name, (_, c) in RULES.items()}
SQL |= {name: f"{with_(PAGES, CLEAN, MEASURED)} SELECT page_id FROM measured WHERE {c}" for name, (_, c) in PROSE.items()}
SQL |= {
    "strip_comments": digest(step("raw", "comments")),
    "strip_media_and_categories": digest(step("raw", "media")),
    "strip_refs": digest(step("raw", "refs")),
    "strip_templates": digest(step("raw", "templates")),
    "unwrap_links": digest(step("raw", "wikilinks")),
    "strip_urls": digest(step("raw", "urls")),
    "strip_bold": digest(step("raw", "bold")),
    "strip_tables": digest(step("raw", "tables")),
    "pipe_cleanup": digest(step("raw", "pipes")),
    "strip_ipa_coordinates": digest(step("raw", "ipa")),
    "decode_entities": digest(decoded("raw")),
    "strip_appendix": digest("text", "cut_raw", appendix("pages", "raw", "cut_raw")),
    "tidy_whitespace": digest(tidy("raw")),
    "sanitize_full": digest("text", "clean", CLEAN),
    "lead_sample": digest("replace(substr(raw, 1, 300), chr(10), ' ')"),
    "strip_tags_html": f"SELECT page_id, length(v) AS n, md5(v) AS digest FROM (SELECT page_id, {step('html', 'comments', 'tags')} AS v FROM pages)",
    "drop_reason_raw": f"{with_(PAGES)} SELECT coalesce({REASON}, 'passed') AS reason, count(*) AS n FROM pages GROUP BY 1",
    "page_reasons": f"{with_(*BASE)} SELECT page_id, coalesce(reason, 'accepted') AS reason FROM judged",
    "accepted_pages": f"{with_(*BASE)} SELECT page_id, title, words, links, md5(text) AS digest FROM accepted",
    "quality_exempt_old": f"{with_(PAGES)} SELECT page_id FROM pages WHERE {QUALITY} AND {OLD}",
    "future_banner_vs_inline": f"{with_(PAGES)} SELECT page_id, {OUTLOOK} AS banner FROM pages WHERE {hit('raw', r'\{\{zukunft')}",
    "word_count": f"{with_(PAGES)} SELECT page_id, {words('raw')} AS words FROM pages",
    "content_links": f"{with_(PAGES)} SELECT page_id, {content_links('raw')} AS links FROM pages",
    "norm_title": f"{with_(PAGES)} SELECT page_id, {norm('title')} AS title FROM src",
    "fnv_hash": f"{with_(PAGES)} SELECT page_id, {fnv('title')} AS h, lpad(lower(hex({fnv('title')})), 8, '0') AS hex8 FROM src",
    "links_extracted": f"{with_(PAGES, GRAPH)} SELECT page_id, source, target, count(*) AS n FROM link GROUP BY ALL",
    "redirects": f"{with_(PAGES, GRAPH)} SELECT source, target FROM redirect",
    "redirect_closure": f"{with_(PAGES, GRAPH)} SELECT source, final FROM final",
    "indegree": f"{with_(PAGES, GRAPH)} SELECT target, {fnv('target')} AS h, indegree FROM degree",
    "indegree_distinct": f"{with_(PAGES, GRAPH)} SELECT target, count(DISTINCT page_id) AS indegree FROM ended GROUP BY target",
    "indegree_percentiles": f"{with_(PAGES, GRAPH)} SELECT p, indegree FROM (SELECT indegree, row_number() OVER (ORDER BY indegree) - 1 AS i, count(*) OVER () AS n FROM degree), (SELECT unnest([10, 50, 90, 99])::INT AS p) WHERE i = least(n - 1, (n * p) // 100)",
    "unlinked_titles": f"{with_(PAGES, GRAPH, TITLES)} SELECT title FROM titles WHERE title NOT IN (SELECT target FROM degree)",
    "title_sidecar": f"{with_(PAGES, GRAPH, TITLES)} SELECT lpad(lower(hex({fnv('d.target')})), 8, '0') AS hash8, indegree, coalesce(first_title, '?') AS title FROM degree d LEFT JOIN titles t ON d.target = t.title",
    "indegree_lookup": f"{with_(PAGES, GRAPH)} SELECT q.title, coalesce(indegree, 0) AS indegree FROM (SELECT unnest(['doc_1', 'Doc 2', 'Nirgends']) AS title) q LEFT JOIN degree d ON {norm('q.title')} = d.target",
    "html_indegree": f"SELECT target, count(*) AS indegree FROM (SELECT {norm('x')} AS target FROM (SELECT unnest(regexp_extract_all(html, 'href=\"/([^\"]*)\"', 1)) AS x FROM pages) WHERE x <> '') WHERE target <> '' GROUP BY target",
    "tier_decision": f"{with_(*WITH_TIERS)} SELECT page_id, title, words, indegree, tier FROM tiered",
    "tier_counts": f"{with_(*WITH_TIERS)} SELECT tier, count(*) AS n, sum(words)::BIGINT AS words FROM tiered GROUP BY tier",
    "tier_without_graph": f"{with_(*BASE, GRAPH, TIER.replace('NOGRAPH', 'false AND'))} SELECT page_id, tier FROM tiered",
    "dedupe_titles": f"{with_(*WITH_TIERS, DEDUPED)} SELECT part, page_id, title FROM deduped",
    "chunk_layout": f"{with_(*STORE)} SELECT part, page_id, local_chunk, \"offset\", length FROM laid",
    "merge_parts": f"{with_(*STORE)} SELECT id, title, content_sample, chunk_id, \"offset\", length, tier FROM store",
    "store_stats": f"{with_(*STORE)} SELECT count(*) AS articles, count(DISTINCT chunk_id) AS chunks, sum(length)::BIGINT AS bytes, coalesce(max(id), 0) AS last_id FROM store",
    "chunk_roundtrip": f"{with_(*STORE)} SELECT id, title, md5(text) AS digest FROM store",
    "fetch_article": f"{with_(*STORE)} SELECT title, length(text) AS n, md5(text) AS digest FROM store WHERE title = 'Doc 40'",
    "token_freq": f"{with_(*STORE, FREQ)} SELECT word, freq FROM freq",
    "vocab_topk": f"{with_(*STORE, FREQ, VOCAB)} SELECT idx, word, freq FROM vocab",
    "delete_index": f"{with_(*STORE, FREQ, VOCAB, DELETES)} SELECT variant, {fnv('variant')} AS h, idx FROM variants",
    "delete_counts": f"{with_(*STORE, FREQ, VOCAB, DELETES)} SELECT count(*) AS entries FROM (SELECT DISTINCT {fnv('variant')} AS h, idx FROM variants)",
    "trigram_postings": f"{with_(*STORE, POSTINGS)} SELECT trigram, id, col, tf FROM postings",
    "search_substring": f"{with_(*STORE, FOUND)} SELECT id, title FROM found",
    "search_tier1_top5": f"{with_(*STORE, FOUND)} SELECT id, title FROM found WHERE tier = 1 ORDER BY id LIMIT 5",
    "search_bm25": f"""{with_(*STORE)}, counted AS (SELECT id, title, greatest(0, length(title) - 2) + greatest(0, length(content_sample) - 2) AS size,
        len(list_filter(range(1, length(title) + 1), lambda i: substr(lower(title), i, {len(TERM)}) = {lit(TERM)})) AS a, len(list_filter(range(1, length(content_sample) + 1), lambda i: substr(lower(content_sample), i, {len(TERM)}) = {lit(TERM)})) AS b FROM store),
        whole AS (SELECT count(*) AS n, avg(size) AS mean, count(*) FILTER (a + b > 0) AS hits FROM counted)
        SELECT id, title, round(-greatest(1e-6, ln((n - hits + 0.5) / (hits + 0.5))) * (10.0 * a + b) * 2.2 / ((10.0 * a + b) + 1.2 * (0.25 + 0.75 * size / mean)), 6) AS score FROM counted, whole WHERE a + b > 0 ORDER BY score, id LIMIT 10""",
    "audit_rescued": f"{with_(*BASE, KNOWN, RESCUED)} SELECT title, words, chars, in_store FROM rescued",
    "audit_missing": f"{with_(*BASE, KNOWN, RESCUED)} SELECT title, words, chars FROM rescued WHERE NOT in_store ORDER BY words DESC, title LIMIT 100",
    "demo_slice": f"""{with_(*WITH_TIERS, DEDUPED)}, picked AS (SELECT page_id, title, text FROM deduped WHERE title IN ({', '.join(map(lit, DEMO_TITLES))}) UNION ALL SELECT -1, {lit(next(iter(DEMO_EXTRA)))}, {lit(next(iter(DEMO_EXTRA.values())))})
        SELECT row_number() OVER (ORDER BY page_id) AS id, title, 1::BIGINT AS chunk_id, coalesce(sum(strlen(text)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", strlen(text) AS length FROM picked""",
    "audit_report": f"""{with_(*BASE, KNOWN, RESCUED)} SELECT 0 AS line, format('{{}} rescued, {{}} of them missing', count(*), count(*) FILTER (NOT in_store)) AS text FROM rescued
        UNION ALL (SELECT row_number() OVER (ORDER BY words DESC, title)::INT, printf('%7d  %s', words, title) FROM rescued WHERE NOT in_store ORDER BY words DESC, title LIMIT 100)""",
    "dump_scan": f"{with_(PAGES)} SELECT page_id, title, length(raw) AS n, md5(raw) AS digest FROM pages WHERE page_id % 9 <> 1",
    "dump_link_pass": f"{with_(PAGES)} SELECT page_id, title, length(raw) AS n, md5(raw) AS digest FROM pages WHERE page_id % 9 NOT IN (1, 2)",
    "dump_parts": "SELECT count(*) AS pages, sum(doc_id)::BIGINT AS ids FROM documents WHERE doc_id % 9 <> 1",
    "extracted_scan": "SELECT 'Doc ' || doc_id AS title, length(v) AS n, md5(v) AS digest FROM (SELECT doc_id, replace(coalesce(text, '') || chr(10), chr(10), chr(10) || chr(10)) AS v FROM documents)",
    "sidecar_file": f"{with_(PAGES, GRAPH, TITLES)} SELECT lpad(lower(hex({fnv('d.target')})), 8, '0') AS hash8, indegree, coalesce(first_title, '?') AS title FROM degree d LEFT JOIN titles t ON d.target = t.title",
    "targets_by_degree": f"""{with_(PAGES, GRAPH, TITLES)} SELECT row_number() OVER (ORDER BY indegree DESC, hash8, title)::INT AS place, hash8, indegree, title
        FROM (SELECT lpad(lower(hex({fnv('d.target')})), 8, '0') AS hash8, indegree, coalesce(first_title, '?') AS title FROM degree d LEFT JOIN titles t ON d.target = t.title) ORDER BY place LIMIT 100""",
    "common_words": f"{with_(*STORE, FREQ)} SELECT word, freq FROM freq ORDER BY freq DESC, word LIMIT 30",
    "build_counts": f"""{with_(*STORE)} SELECT pages, accepted, pages - accepted AS skipped, accepted - articles AS duplicates, articles, chunks FROM
        (SELECT (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM tiered) AS accepted, (SELECT count(*) FROM store) AS articles, (SELECT count(DISTINCT chunk_id) FROM store) AS chunks)""",
    "bench_sample": f"{with_(PAGES, CLEAN)} SELECT page_id, title, length(text) AS n FROM pages JOIN clean USING (page_id) WHERE title <> '' AND length(text) >= 200 ORDER BY part, page_id LIMIT 100",
}
#: DuckDB counts edits in bytes, so letters beyond ASCII become capitals, which the words don't hold.
PLAIN = "translate({0}, 'äöüßéèêçñíóáúàâîôûëï', 'ABCDEFGHIJKLMNOPQRST')"
SQL["spell_lookup"] = f"""{with_(*STORE, FREQ, VOCAB, DELETES, ASKED)}, q1 AS (SELECT query, unnest({DELETE.format('query')}) AS variant FROM asked), q2 AS (SELECT query, unnest({DELETE.format('variant')}) AS variant FROM q1),
    probe AS (SELECT query, query AS variant FROM asked UNION SELECT * FROM q1 UNION SELECT * FROM q2),
    pair AS (SELECT DISTINCT query, idx FROM probe JOIN variants USING (variant))
    SELECT query, word, damerau_levenshtein({PLAIN.format('query')}, {PLAIN.format('word')})::INT AS distance, freq FROM pair JOIN vocab USING (idx) WHERE distance <= 2"""
