"""Queries on what to search for and what was found: tags, query texts, web hits, locators, stored retrievals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assessment as a
from ..operators import headings as h
from ..operators import intents as i
from ..operators import retrieval as r
from .base import table
from .policy import _ASSESSED_SQL, _assessed, _pick

GROUPS, SURGERIES = ("Thoracic_Surgery", "", "Urology"), (" Lobectomy ", "", "Hernia repair")


def english_flags(spark, sf_dir):
    """Every flag and note in English."""
    s = _assessed(spark, sf_dir).withColumn("flags", a.risk_flags()).withColumn("notes", a.notes())
    said = lambda c: F.array_join(i.all_english(F.col(c)), "|")
    return s.select("ord", said("flags").alias("flags"), said("notes").alias("notes"))


_NUMBER = lambda text, n, form="%.0f": "'" + text.split("{}")[0] + f"' || printf('{form}', ({n})::DOUBLE) || '" + text.split("{}")[1] + "'"
_ENGLISH_SQL = f"""{_ASSESSED_SQL}, en AS (SELECT *, list_filter([
  CASE WHEN m IS NULL THEN NULL WHEN m55 >= 30 THEN {_NUMBER('severe hypotension (MAP < 55 mmHg for about {} s, >= 30 s)', 'm55')} WHEN m65 >= 60 THEN {_NUMBER('hypotension (MAP < 65 mmHg for about {} s, >= 60 s)', 'm65')} WHEN m < 65 THEN 'MAP below 65 mmHg but lasting less than 60 s (early warning)' END,
  CASE WHEN h IS NULL THEN NULL WHEN h100 >= 60 THEN {_NUMBER('tachycardia (HR > 100 bpm for about {} s)', 'h100')} WHEN h50 >= 60 THEN {_NUMBER('bradycardia (HR < 50 bpm for about {} s)', 'h50')} END,
  CASE WHEN o IS NULL THEN NULL WHEN o90 >= 30 THEN {_NUMBER('severe hypoxemia (SpO2 < 90% for about {} s)', 'o90')} WHEN o94 >= 60 THEN {_NUMBER('oxygen desaturation (SpO2 < 94% for about {} s)', 'o94')} END,
  CASE WHEN b IS NULL THEN 'BIS unavailable; infer anesthetic depth from MAP/HR/SpO2 trends and surgical stimulation' WHEN b60 >= 120 THEN {_NUMBER('persistently elevated BIS (>60 for about {} s; interpret with stimulation and EMG)', 'b60')}
    WHEN b40 >= 120 THEN {_NUMBER('persistently low BIS (<40 for about {} s; evaluate possible hypoperfusion)', 'b40')} WHEN b > 60 OR b < 40 THEN 'brief BIS deviation lasting less than 120 s; not a standalone drug trigger' END,
  CASE WHEN relative THEN {_NUMBER('marked MAP decrease from baseline ({}%)', 'fall', '%.1f')} END, CASE WHEN absolute THEN 'absolute MAP threshold triggered; prioritize organ perfusion floor' END,
  CASE WHEN relative THEN 'relative MAP drop triggered; use for individualized risk stratification' END,
  CASE WHEN rhythm AND said <> '' THEN '心律事件标注：' || said END, CASE WHEN rhythm AND regexp_matches(lower(said), 'vf|vt|ventricular|asystole|torsade|af with rvr') THEN '严重心律失常风险（arrdb标注）' END], lambda x: x IS NOT NULL) AS ef,
  list_filter([CASE WHEN m < 65 AND h < 50 THEN 'low MAP with low HR suggests anesthetic depression or conduction suppression; avoid simply deepening anesthesia' END,
  CASE WHEN m < 65 AND h > 100 THEN 'low MAP with high HR suggests hypovolemia, bleeding, or stress response; do not escalate drugs based on BIS alone' END,
  CASE WHEN m < 65 AND key IN ('PPF20_VOL', 'SEVO_ET_RATE', 'MAC_RATE') AND delta > 0 THEN 'low MAP while anesthesia is being deepened suggests drug-induced hypotension risk; protect perfusion first' END,
  CASE WHEN m < 65 AND key IN ('NOR_RATE', 'EPH_VOL', 'PHE_RATE', 'EPI_RATE', 'DOPA_RATE') THEN 'low MAP despite vasopressor background suggests refractory hypotension; reassess cause and volume status' END,
  CASE WHEN b > 60 AND m < 65 THEN 'high BIS with hypotension should not trigger automatic deepening; stabilize circulation first' WHEN b > 60 AND h > 100 THEN 'high BIS with HR/MAP surge suggests inadequate analgesia or combined hypnotic-analgesic insufficiency' END,
  CASE WHEN b < 40 AND m < 65 THEN 'low BIS with low MAP suggests excessive anesthetic depth and hypoperfusion; lighten anesthesia and support circulation' END], lambda x: x IS NOT NULL) AS ew FROM lv)"""
ENGLISH = f"WITH {_ENGLISH_SQL} SELECT ord, array_to_string(ef, '|') AS flags, array_to_string(ew, '|') AS notes FROM en"


def _tagged(spark, sf_dir, mode="paired_only"):
    s = _assessed(spark, sf_dir).withColumn("flags", a.risk_flags()).withColumn("notes", a.notes())
    s = s.withColumn("surgery_group", _pick(GROUPS, F.col("ord"))).withColumn("surgery_type", _pick(SURGERIES, F.col("ord"))).withColumn("context", F.array(F.lit("Hypertension "), F.lit(" ")))
    return s.withColumn("tags", i.intents(mode))


def intent_tags(spark, sf_dir):
    return _tagged(spark, sf_dir).select("ord", F.array_join("tags", "|").alias("tags"), i.rewritten(F.col("tags")).alias("rewritten"))


def intent_tags_full(spark, sf_dir):
    """With tags for an isolated BIS, and all that fit."""
    s = _assessed(spark, sf_dir).withColumn("flags", a.risk_flags()).withColumn("notes", a.notes())
    s = s.withColumn("surgery_group", _pick(GROUPS, F.col("ord"))).withColumn("surgery_type", _pick(SURGERIES, F.col("ord"))).withColumn("context", F.array(F.lit("Hypertension "), F.lit(" ")))
    return s.select("ord", F.array_join(i.intents("full", 40), "|").alias("tags"))


def _when(cond: str, *texts: str) -> str:
    return ", ".join(f"CASE WHEN {cond} THEN '{t}' END" for t in texts)


def _tags_sql(full: bool) -> str:
    stable = "NOT coalesce(m < 65, false) AND NOT coalesce(h > 100 OR h < 50, false) AND NOT coalesce(o < 94, false)"
    alone = [
        _when("b > 60", "high BIS during general anesthesia"), _when(f"b > 60 AND {stable}", "isolated high BIS with stable hemodynamics", "prevention of intraoperative awareness", "hypnotic titration while preserving perfusion"),
        _when("b < 40", "low BIS during general anesthesia"), _when(f"b < 40 AND {stable}", "isolated low BIS with stable hemodynamics", "avoid excessive anesthetic depth"),
    ]
    tags = [
        "CASE WHEN ord % 3 = 0 THEN 'thoracic surgery anesthesia' WHEN ord % 3 = 2 THEN 'urology anesthesia' END", "CASE WHEN ord % 3 = 0 THEN 'lobectomy' WHEN ord % 3 = 2 THEN 'hernia repair' END", "'hypertension'",
        _when("m < 55", "intraoperative severe hypotension", "perfusion-first management"), _when("m >= 55 AND m < 65", "intraoperative hypotension", "perfusion-first management"), _when("fall >= 20", "relative MAP decrease from baseline"),
        _when("o < 90", "intraoperative hypoxemia", "oxygenation-first management"), _when("o >= 90 AND o < 94", "oxygen desaturation during anesthesia"), _when("h > 100", "intraoperative tachycardia"), _when("h < 50", "intraoperative bradycardia"),
        *(alone if full else []),
        _when("m < 65 AND b > 60", "high BIS with hypotension", "do not deepen anesthesia before stabilizing perfusion"), _when("m < 65 AND b < 40", "excessive anesthetic depth with hypoperfusion", "reduce anesthetic depth and support circulation"),
        _when("b > 60 AND h > 100", "inadequate analgesia versus inadequate anesthetic depth"), _when("key IN ('REMI_RATE', 'RFTN20_RATE')", "opioid titration during general anesthesia"), _when("key = 'PPF20_VOL'", "propofol adjustment during general anesthesia"),
        _when("key IN ('SEVO_ET_RATE', 'MAC_RATE')", "volatile anesthetic adjustment"), _when("key IN ('PHE_RATE', 'EPH_VOL', 'NOR_RATE', 'EPI_RATE')", "vasopressor choice during intraoperative hypotension"),
    ]
    fits = "x <> ''" if full else "x <> '' AND (NOT contains(x, 'bis') OR regexp_matches(x, 'map|hypotension|perfusion|hr|tachycardia|bradycardia|spo2|oxygen'))"
    hints = f"list_filter(list_transform(list_slice(ef, 1, 3) || list_slice(ew, 1, 2), lambda x: lower(x)), lambda x: {fits})"
    return f"""{_ENGLISH_SQL}, tg AS (SELECT *, list_filter([{', '.join(tags)}], lambda x: x IS NOT NULL) || {hints} AS raw FROM en),
td AS (SELECT *, list_slice(list_filter(raw, lambda x, k: list_position(raw, x) = k), 1, {40 if full else 8}) AS tags FROM tg)"""


INTENTS = f"WITH {_tags_sql(False)} SELECT ord, array_to_string(tags, '|') AS tags, array_to_string(tags, '; ') AS rewritten FROM td"
INTENTS_FULL = f"WITH {_tags_sql(True)} SELECT ord, array_to_string(tags, '|') AS tags FROM td"


def retrieval_query(spark, sf_dir):
    s = _tagged(spark, sf_dir).withColumn("background", F.struct(F.lit("67").alias("age"), F.when(F.col("ord") % 2 == 0, "M").alias("sex"), F.lit(None).cast("string").alias("asa"), F.lit("Chest").alias("department")))
    s = s.withColumn("stage", F.lit("late")).withColumn("intervention_type", F.lit("rate_adjustment"))
    return s.select("ord", F.md5(i.retrieval_query("full")).alias("md5"))


# numbers of a state are printed as doubles
_NUM = lambda v: f"replace(printf('%.6f', ({v})::DOUBLE), '.000000', '.0')"
_COUPLED = "(coalesce(m < 65, false) OR coalesce(h > 100 OR h < 50, false) OR coalesce(o < 94, false))"
RETRIEVAL_QUERY = f"""WITH {_tags_sql(False)}, q AS (SELECT *, array_to_string(list_filter([CASE WHEN m IS NOT NULL THEN 'MAP ' || {_NUM('m')} || ' mmHg' END, CASE WHEN h IS NOT NULL THEN 'HR ' || {_NUM('h')} || ' bpm' END, CASE WHEN o IS NOT NULL THEN 'SpO2 ' || {_NUM('o')} || '%' END, CASE WHEN b IS NOT NULL THEN 'BIS ' || {_NUM('b')} END], lambda x: x IS NOT NULL), ', ') AS state,
  CASE WHEN b > 60 AND h > 100 THEN 'high BIS with sympathetic activation under surgical stimulation, analgesic-hypnotic balance, ' WHEN b > 60 AND {_COUPLED} THEN 'high BIS coupled with physiologic instability; avoid automatic deepening before perfusion/oxygenation is secured, '
    WHEN b < 40 AND {_COUPLED} THEN 'low BIS coupled with physiologic instability; assess excessive depth versus hypoperfusion, ' WHEN b > 60 THEN 'isolated high BIS with stable hemodynamics; prevention of intraoperative awareness and cautious hypnotic titration, '
    WHEN b < 40 THEN 'isolated low BIS with stable hemodynamics; avoid excessive anesthetic depth, ' ELSE '' END AS phrase FROM td)
SELECT ord, md5('Perioperative anesthesia evidence retrieval query: 67-year-old ' || CASE WHEN ord % 2 = 0 THEN 'male' ELSE 'unknown sex' END || ', ASA unknown ASA, department Chest, surgery group ' || (['Thoracic_Surgery', '', 'Urology'])[ord % 3 + 1] || ', undergoing ' || (['Lobectomy', 'unknown surgery', 'Hernia repair'])[ord % 3 + 1]
  || '. Current stage: late. Preoperative context: Hypertension ;  . Recent mean physiologic state: ' || CASE WHEN state = '' THEN 'available physiologic signals not provided' ELSE state END || '. Risk flags: ' || array_to_string(list_slice(ef, 1, 4), '; ') || '. Clinical interpretation: ' || array_to_string(list_slice(ew, 1, 3), '; ')
  || '. Intent tags: ' || array_to_string(tags, '; ') || '. Rewritten retrieval focus: ' || array_to_string(tags, '; ') || '. Candidate intervention context for retrieval disambiguation: medication key ' || key || ', intervention type rate_adjustment; prioritize physiologic evidence first. '
  || 'Retrieve the most relevant Miller anesthesia evidence on anesthetic depth adjustment, analgesic titration, hemodynamic safety thresholds, perfusion-first priority, oxygenation-first priority, ' || phrase || 'and medication choice for this physiologic scenario.') AS md5 FROM q"""

TITLES = ("Miller's Anesthesia 10th edition", "Anaesthesia basics", "Cooking", "米勒麻醉学 第十版")


def web_hits(spark, sf_dir):
    """Pages as hits of searches, ten to a search, kept by their score or all if none scores enough."""
    p = table(spark, sf_dir, "pages").withColumn("query_id", F.floor(F.col("page_id") / 3)).withColumn("title", F.when(F.col("query_id") % 4 == 3, F.lit("News")).otherwise(_pick(TITLES, F.col("page_id"))))
    hits = p.withColumn("hit_score", i.hit_score(F.col("title"), F.col("url"), F.lit("")))
    strict = i.kept_hits(hits, "query_id", "hit_score", 3, strict=True).select("page_id", F.lit(True).alias("strict"))
    return i.kept_hits(hits, "query_id", "hit_score", 3).select("page_id", "query_id", "hit_score").join(strict, "page_id", "left").withColumn("strict", F.coalesce("strict", F.lit(False)))


_WEB_SQL = f"""t AS (SELECT page_id, url, page_id // 3 AS query_id, CASE WHEN page_id // 3 % 4 = 3 THEN 'News' ELSE (['{"', '".join(x.replace("'", "''") for x in TITLES)}'])[page_id % 4 + 1] END AS title FROM pages),
s AS (SELECT *, CASE WHEN contains(lower(title || ' ' || url), 'miller') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(lower(title || ' ' || url), 'anesthesia|anaesthesia|麻醉') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(lower(title || ' ' || url), '10th|tenth|第十版') THEN 2 ELSE 0 END
  + CASE WHEN regexp_matches(lower(title || ' ' || url), 'edition|版') THEN 1 ELSE 0 END AS hit_score FROM t)"""
WEB_HITS = f"WITH {_WEB_SQL} SELECT page_id, query_id, hit_score::INTEGER AS hit_score, hit_score >= 3 AS strict FROM (SELECT *, max(hit_score) OVER (PARTITION BY query_id) AS top FROM s) WHERE hit_score >= 3 OR top < 3"


def _hit_texts(spark, sf_dir):
    """Pages as web hits: what they say around their own words, and what is stored with some of them."""
    p, k = table(spark, sf_dir, "pages"), F.col("page_id")
    body = F.regexp_replace("html", "<[^>]*>", " ")
    form = lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    forms = [form("Chapter ", k % 150, ": ", body), form("see Page: ", k % 99999, " of ", body), body, form("In chapter", k % 90, " - ", body, "| p. ", k % 500), form(body, " P.", k % 70, ", end"), form("subchapter 4 ", body)]
    stored = {
        "chapter": F.when(k % 3 == 0, " 5 Heart "), "section": F.when(k % 7 == 0, " Valves "), "page": F.when(k % 5 == 0, "99"),
        "source": F.when(k % 11 == 0, "inferred_by_gpt").when(k % 11 == 1, "source_snippet").when(k % 11 == 2, "hearsay"), "confidence": F.when(k % 4 == 0, 0.9).when(k % 4 == 1, 0.3),
    }
    return p.select(k, "url", F.get(F.array(*forms), (k % 6).cast("int")).alias("snippet"), *[v.alias(n) for n, v in stored.items()])


def web_locators(spark, sf_dir):
    """What every page's text, or what is stored with it, says of chapter and page, with and without a model's word."""
    hits = _hit_texts(spark, sf_dir)
    of = {n: F.col(n) for n in hits.columns if n != "page_id"}
    rank = F.col("page_id") % 10 + 1
    both = hits.select("page_id", h.web_locator(of, rank).alias("f"), h.web_locator(of, rank, allow_inferred=True).alias("g"))
    k = F.col("page_id")
    query = i.web_query([F.when(k % 2 == 0, F.lit(" stored "))], [F.lit("a "), F.lit(" "), F.lit("b")], "10th")
    return both.select("page_id", "f.chapter", "f.section", "f.page", "f.source", "f.confidence", "f.locator", F.col("g.source").alias("source_inferred"), F.col("g.confidence").alias("confidence_inferred"), F.col("g.locator").alias("locator_inferred"), query.alias("query"))


def _locator_sql() -> str:
    """Both readings; where a page's own words name a page, the first piece after a p that begins a word tells it."""
    said = """CASE WHEN inferred AND NOT {allow} THEN 'unknown' WHEN src = '' AND model THEN CASE WHEN {allow} THEN 'inferred_by_gpt' ELSE 'unknown' END WHEN src = '' THEN 'unknown' ELSE src END"""
    sure = "CASE {0} WHEN 'source_snippet' THEN CASE WHEN conf <= 0 THEN 0.8 ELSE conf END WHEN 'inferred_by_gpt' THEN least(CASE WHEN conf = 0 THEN 0.5 ELSE conf END, 0.6) ELSE 0 END::DOUBLE"
    shown = "'[WebM10#' || (page_id % 10 + 1) || ' | 术中相关章节: ' || CASE WHEN {0} = 'unknown' THEN '章节定位不足' ELSE coalesce(nullif(chapter_, ''), nullif(section_, ''), '章节定位不足') END || ' | p.' || CASE WHEN {0} = 'source_snippet' AND page_ <> '' THEN page_ ELSE '?' END || ']'"
    return rf"""WITH b AS (SELECT page_id, url, page_id % 6 AS v, regexp_replace(html, '<[^>]*>', ' ', 'g') AS body FROM pages),
t AS (SELECT *, CASE v WHEN 0 THEN 'Chapter ' || page_id % 150 || ': ' || body WHEN 1 THEN 'see Page: ' || page_id % 99999 || ' of ' || body WHEN 2 THEN body WHEN 3 THEN 'In chapter' || page_id % 90 || ' - ' || body || '| p. ' || page_id % 500 WHEN 4 THEN body || ' P.' || page_id % 70 || ', end' ELSE 'subchapter 4 ' || body END AS snippet,
  CASE WHEN page_id % 3 = 0 THEN '5 Heart' ELSE '' END AS c, CASE WHEN page_id % 7 = 0 THEN 'Valves' ELSE '' END AS s, CASE WHEN page_id % 5 = 0 THEN '99' ELSE '' END AS p,
  CASE page_id % 11 WHEN 0 THEN 'inferred_by_gpt' WHEN 1 THEN 'source_snippet' ELSE '' END AS stored, CASE page_id % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.3 ELSE 0 END AS stored_conf FROM b),
w AS (SELECT *, ltrim(string_split_regex(ltrim(body, chr(32) || chr(9) || chr(10) || chr(13)) || ' ' || url, '[|.;' || chr(10) || ']')[1]) AS opening,
  list_filter([regexp_extract(x, '^(?:age|\.)?\s*[:.]?\s*([0-9]+)(?:[^\pL\pN_]|$)', 1) FOR x IN string_split_regex(' ' || snippet || ' ' || url, '[^\pL\pN_][Pp]')[2:]], lambda n: length(n) BETWEEN 1 AND 4) AS numbers FROM t),
x AS (SELECT *, CASE WHEN v IN (0, 3) AND length(opening) >= 2 THEN CASE v WHEN 0 THEN page_id % 150 ELSE page_id % 90 END::VARCHAR END AS number, trim(left(opening, 120), ' ' || chr(9) || chr(10) || chr(13)) AS title, numbers[1] AS said FROM w),
y AS (SELECT *, c = '' AND number IS NOT NULL AS by_chapter, p = '' AND said IS NOT NULL AS by_page, c || s || p <> '' AS model FROM x),
z AS (SELECT *, CASE WHEN by_chapter THEN number || ' ' || title ELSE c END AS chapter_, CASE WHEN by_chapter AND s = '' THEN title ELSE s END AS section_, CASE WHEN by_page THEN said ELSE p END AS page_,
  CASE WHEN by_chapter OR (by_page AND stored = '') THEN 'source_snippet' ELSE stored END AS src, CASE WHEN by_chapter OR by_page THEN greatest(stored_conf, 0.8) ELSE stored_conf END AS conf FROM y),
i AS (SELECT *, src = 'inferred_by_gpt' AS inferred FROM z),
r AS (SELECT *, {said.format(allow='false')} AS f, {said.format(allow='true')} AS g FROM i)
SELECT page_id, CASE WHEN f = 'unknown' THEN '' ELSE chapter_ END AS chapter, CASE WHEN f = 'unknown' THEN '' ELSE section_ END AS section, CASE WHEN f = 'source_snippet' THEN page_ ELSE '' END AS page, f AS source, {sure.format('f')} AS confidence, {shown.format('f')} AS locator,
  g AS source_inferred, {sure.format('g')} AS confidence_inferred, {shown.format('g')} AS locator_inferred, CASE WHEN page_id % 2 = 0 THEN 'stored; 10th' ELSE 'a; b; 10th' END AS query FROM r"""


def heading_rules(spark, sf_dir):
    """Every line of every document as a heading of one kind or another."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "body"))
    k = F.col("doc_id") + F.col("line_no")
    number = (F.col("doc_id") * 7 % 131).cast("string")
    forms = [F.concat(F.lit(before), number, F.lit(between), F.col("body"), F.lit(after)) for before, between, after in (("Chapter ", ": ", " 441"), ("", " • ", ""), ("", " ", " "), ("", " - ", " 12 Next part"), ("Contents ", " ", ""))]
    d = d.select("doc_id", "line_no", F.get(F.array(*forms, F.col("body")), (k % 6).cast("int")).alias("line"))
    d = d.withColumn("clean", h.clean_heading(F.col("line")))  # the costly step, once a line
    d = d.withColumn("h", h.parts_of_clean(F.col("clean")))
    locator = r.display_locator(F.col("h.number").cast("string"), F.col("h.title"), F.lit(" 12 "), F.col("line"))
    return d.select("doc_id", "line_no", "h.number", F.md5("h.title").alias("title"), F.md5("clean").alias("clean"), r.noise_of_clean(F.col("clean")).alias("noise"), F.md5(locator).alias("locator"))


def _heading_sql() -> str:
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    digits = "'0123456789'"

    def clean(x: str, named: str) -> str:
        """A page number between words, then one at the end."""
        words = f"string_split({x}, ' ')"
        at = f"list_filter(range(2, len({words})), lambda k: length({words}[k]) BETWEEN 2 AND 4 AND rtrim({words}[k], {digits}) = '' AND regexp_matches(left({words}[k + 1], 1), '[A-Za-z]'))[1]"
        return f"CASE WHEN {named} OR {at} IS NULL THEN {x} ELSE array_to_string({words}[:{at} - 1], ' ') END"

    end = lambda x: f"rtrim(left({x}, length({x}) - least(4, length({x}) - length(rtrim({x}, {digits})))))"
    intraop = "intraoperative|monitor|anesthesia|surgery|hemodynamic|oxygenation|airway|pain|nociception"
    return rf"""WITH l AS (SELECT doc_id, n - 1 AS line_no, string_split(text, chr(10))[n] AS body FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) u(n)),
f AS (SELECT *, (doc_id + line_no) % 6 AS v, doc_id * 7 % 131 AS number FROM l),
t AS (SELECT *, CASE v WHEN 0 THEN 'Chapter ' || number || ': ' || body || ' 441' WHEN 1 THEN number || ' • ' || body WHEN 2 THEN number || ' ' || body || ' ' WHEN 3 THEN number || ' - ' || body || ' 12 Next part' WHEN 4 THEN 'Contents ' || number || ' ' || body ELSE body END AS line FROM f),
q AS (SELECT *, trim(regexp_replace(line, '[\s\x00\x0B\x{{85}}\p{{Z}}]+', ' ', 'g')) AS x FROM t),
c AS (SELECT *, {clean('x', 'v = 0')} AS y FROM q), c2 AS (SELECT *, {end('y')} AS z FROM c),
p AS (SELECT *, CASE v WHEN 0 THEN regexp_extract(z, '^Chapter ([0-9]+): *(.*)$', 2) WHEN 1 THEN regexp_extract(z, '^[0-9]+ • *(.*)$', 1) WHEN 2 THEN regexp_extract(z, '^[0-9]+ +(.*)$', 1) WHEN 3 THEN regexp_extract(z, '^[0-9]+ - *(.*)$', 1) ELSE '' END AS raw FROM c2),
p1 AS (SELECT *, CASE WHEN v = 0 THEN raw <> '' ELSE regexp_matches(left(raw, 1), CASE v WHEN 2 THEN '[A-Z]' ELSE '[A-Za-z]' END) AND length(raw) BETWEEN 4 AND 181 AND translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 ,:&()/-''’', '') = '' END AS fits FROM p),
p2 AS (SELECT *, {clean('raw', "raw = ''")} AS y2 FROM p1), p3 AS (SELECT *, {end('y2')} AS title_ FROM p2),
g AS (SELECT *, fits AND number BETWEEN 1 AND 120 AND regexp_matches(title_, '[A-Za-z][A-Za-z][A-Za-z]') AND lower(string_split(title_, ' ')[1]) NOT IN ('this', 'these', 'they', 'there', 'when', 'however', 'conversely', 'more', 'although', 'because') AS good FROM p3)
SELECT doc_id, line_no::INTEGER AS line_no, CASE WHEN good THEN number END::INTEGER AS number, CASE WHEN good THEN md5(title_) END AS title, md5(z) AS clean, z = '' OR regexp_matches(lower(z), 'references|contents|index|acknowledgments|copyright') AS noise,
  md5('[M10 | ' || CASE WHEN regexp_matches(lower(CASE WHEN good THEN number || ' ' || title_ || ' ' ELSE '' END || line), '{intraop}|术中|麻醉|监测|并发症|循环|氧合') THEN '术中相关章节: ' ELSE '相关章节: ' END || CASE WHEN good THEN coalesce(nullif(title_, ''), number::VARCHAR) ELSE '章节定位不足' END || ' | p.12]') AS locator FROM g"""


def passages_prepared(spark, sf_dir):
    """Passages with their prefix, those long enough, and how sure their chapter is."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    d = d.select(k.alias("chunk_id"), "text", F.when(k % 3 == 0, F.concat(F.lit("Ch"), k)).alias("outline_chapter"), F.when(k % 2 == 0, "Heading").alias("heading_chapter"), F.when(k % 5 == 0, " sec ").alias("section"))
    out = r.prepared(d, least_chars=300, book="Book")
    return out.select("chunk_id", F.md5("text").alias("md5"), "chapter", "chapter_source", "chapter_confidence", "char_count", h.chapter_of_prefix(F.col("text")).alias("recovered"))


PREPARED = """WITH x AS (SELECT doc_id AS chunk_id, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, CASE WHEN doc_id % 3 = 0 THEN 'Ch' || doc_id WHEN doc_id % 2 = 0 THEN 'Heading' END AS chapter, doc_id % 3 = 0 AS o, doc_id % 2 = 0 AS h, doc_id % 5 = 0 AS s FROM documents),
y AS (SELECT *, '[书籍: Book' || coalesce(', 章节: ' || chapter, '') || CASE WHEN s THEN ', 子节: sec' ELSE '' END || ']' || chr(10) || t AS text FROM x WHERE length(t) >= 300)
SELECT chunk_id, md5(text) AS md5, chapter, CASE WHEN o THEN 'outline' WHEN h THEN 'heading' END AS chapter_source, CASE WHEN o THEN 0.95 WHEN h THEN 0.55 END::DOUBLE AS chapter_confidence, length(t)::INTEGER AS char_count, coalesce(chapter, '') AS recovered FROM y"""


def retrieval_reuse(spark, sf_dir):
    """Stored hits where a query has them, ranked ones for the rest."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    stored = q.filter("query_id % 2 = 0").select("query_id", (F.col("query_id") + 1000).alias("chunk_id"), F.lit(1).alias("rank"))
    return r.reused(q, stored, lambda open_: r.bm25(corpus, open_, 3).select("query_id", "chunk_id", "rank"))


def _reuse_sql() -> str:
    from .retrieval import _bm25_sql

    return f"""WITH {_bm25_sql(3)} SELECT query_id, chunk_id, rank FROM bm WHERE score > 0 AND query_id % 2 <> 0 UNION ALL SELECT item_id, item_id + 1000, 1 FROM benchmark WHERE item_id % 2 = 0"""


REGISTER = [
    ("english_flags", english_flags, ENGLISH),
    ("intent_tags", intent_tags, INTENTS),
    ("intent_tags_full", intent_tags_full, INTENTS_FULL),
    ("retrieval_query", retrieval_query, RETRIEVAL_QUERY),
    ("web_hits", web_hits, WEB_HITS),
    ("web_locators", web_locators, _locator_sql()),
    ("heading_rules", heading_rules, _heading_sql()),
    ("passages_prepared", passages_prepared, PREPARED),
    ("retrieval_reuse", retrieval_reuse, _reuse_sql()),
]
