"""Queries of the functions on text, numbers and geometry, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.functions import ocr, text as X
from talkweave.runtime import table
from talkweave.settings import Layout
from talkweave.sources import tables as T

QUERIES: dict = {}
SQL: dict = {}
# White space and line breaks as Python knows them, for DuckDB's regular expressions.
_WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_BREAK = r"(?:\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])"
_BULLET = r"^(?:[•‣◦⁃∙*\-]|\p{Nd}+[.)]|[a-zA-Z][.)])" + _WS + "+"
_NAME = X.NAME_LINE.replace(r"\s", _WS)


def _strip(c):
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def _n_words(c):
    return f"len(list_filter(regexp_split_to_array({c}, '{_WS}+'), lambda w: w <> ''))"


_LINES = rf"""
with d as (select doc_id, case when text = '' then [] else regexp_split_to_array(regexp_replace(text, '{_BREAK}\z', ''), '{_BREAK}') end ls from documents where text is not null),
l as (select doc_id, i line_no, ls[i] line from d, unnest(range(1, len(ls) + 1)) x(i))
"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _lines(spark, folder):
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", X.lines(F.col("text")).alias("ls"))
    return d.select("doc_id", F.posexplode("ls").alias("i", "line")).select("doc_id", (F.col("i") + 1).cast("bigint").alias("line_no"), "line")


@query(_LINES + "select doc_id, line_no, line from l")
def doc_lines(spark, folder):
    """Lines of every text."""
    return _lines(spark, folder)


@query(
    _LINES
    + f"select doc_id, line_no, regexp_matches(line, '{_BULLET}') or {_n_words('line')} <= 8 is_bullet, {_strip(f"regexp_replace(line, '{_BULLET}', '')")} bare from l where {_strip('line')} <> ''"
)
def bullet_or_paragraph(spark, folder):
    """Kind of every line that is not blank, and the line without its marker."""
    d = _lines(spark, folder).where(X.strip(F.col("line")) != "")
    return d.select("doc_id", "line_no", X.is_bullet(F.col("line")).alias("is_bullet"), X.without_marker(F.col("line")).alias("bare"))


def _pages(spark, folder):
    """Documents as pages whose lines are as high as they are long."""
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", X.lines(F.col("text")).alias("ls"))
    line = lambda t, i: F.struct(t.alias("text"), F.lit(0.9).alias("confidence"), F.lit(0.0).alias("left"), i.cast("double").alias("top"), F.lit(1.0).alias("width"), F.length(t).cast("double").alias("height"))
    return d.select("doc_id", F.transform("ls", line).alias("page"))


_TITLE = _LINES + ", t as (select doc_id, min(line_no) line_no from (select *, max(length(line)) over (partition by doc_id) m from l) where length(line) >= 0.7::double * m group by 1)\n"


@query(_TITLE + "select d.doc_id, t.line_no - 1 title_index, l.line title from d left join t using (doc_id) left join l on l.doc_id = t.doc_id and l.line_no = t.line_no")
def title_line(spark, folder):
    """The first line nearly as high as the highest."""
    i = ocr.title_index(F.col("page"))
    return _pages(spark, folder).select("doc_id", i.cast("bigint").alias("title_index"), F.get(F.transform("page", lambda x: x["text"]), i).alias("title"))


@query(
    _TITLE
    + f""",
k as (select l.doc_id, l.line_no, l.line, regexp_matches(l.line, '{_BULLET}') or {_n_words('l.line')} <= 8 b from l join t on t.doc_id = l.doc_id and t.line_no <> l.line_no)
select d.doc_id, (select l.line from t join l using (doc_id, line_no) where t.doc_id = d.doc_id) title,
       coalesce((select string_agg({_strip(f"regexp_replace(k.line, '{_BULLET}', '')")}, '|' order by line_no) from k where k.doc_id = d.doc_id and b), '') bullets,
       coalesce((select string_agg(k.line, '|' order by line_no) from k where k.doc_id = d.doc_id and not b), '') paragraphs,
       coalesce((select string_agg(l.line, chr(10) order by line_no) from l where l.doc_id = d.doc_id), '') raw_text
from d"""
)
def classify_content(spark, folder):
    """Title, bullets, paragraphs and raw text of every page."""
    d = _pages(spark, folder).select("doc_id", ocr.content(F.col("page"), F.lit(None).cast("int")).alias("c"))
    return d.select("doc_id", "c.title", F.array_join("c.bullet_points", "|").alias("bullets"), F.array_join("c.paragraphs", "|").alias("paragraphs"), "c.raw_text")


@query(
    _LINES
    + f"""
select doc_id, line_no - 1 as top, {_strip('line')} as text, 0.5::double confidence, 1.0::double height
from l where line_no <= (select len(ls) - 1 from d where d.doc_id = l.doc_id) and {_strip('line')} <> ''"""
)
def ocr_page_lines(spark, folder):
    """Lines of parallel arrays; one score too few drops the last line."""
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", X.lines(F.col("text")).alias("ls"))
    scores = F.array_repeat(F.lit(0.5), F.greatest(F.size("ls") - 1, F.lit(0)))
    nothing = F.lit(None)
    page = ocr.page_lines(F.col("ls"), scores, nothing.cast("array<array<double>>"), nothing.cast("array<array<array<double>>>"))
    return d.select("doc_id", F.explode(page).alias("x")).select("doc_id", F.col("x.top").cast("bigint").alias("top"), "x.text", "x.confidence", "x.height")


@query(
    _LINES
    + r", m as (select doc_id, min(line_no) line_no from l where regexp_matches(line, '\p{L}') group by 1)"
    + f"\nselect d.doc_id, {_strip('l.line')} name from d left join m using (doc_id) left join l on l.doc_id = m.doc_id and l.line_no = m.line_no"
)
def crop_name_pick(spark, folder):
    """The first line with a letter."""
    return _pages(spark, folder).select("doc_id", ocr.crop_name(F.col("page")).alias("name"))


@query(
    f"""with p as (select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name from part)
select p_partkey, name, {_n_words('name')} <= 4 and regexp_matches({_strip('name')}, '{_NAME}') name_shaped from p"""
)
def name_shaped_parts(spark, folder):
    """Names of parts in title case, shaped like persons' names or not."""
    d = table(spark, folder, "part").select("p_partkey", F.initcap("p_name").alias("name"))
    return d.select("p_partkey", "name", X.is_name_shaped(F.col("name")).alias("name_shaped"))


@query(r"select display_name, regexp_matches(display_name, '\p{L}') has_letter, " + f"{_n_words('display_name')} <= 4 and regexp_matches({_strip('display_name')}, '{_NAME}') name_shaped, count(*) n from visual_speaker_events where display_name is not null group by 1")
def display_name_shapes(spark, folder):
    """Which names on screen have letters and are shaped like persons' names."""
    d = table(spark, folder, "visual_speaker_events").where("display_name is not null").groupBy("display_name").agg(F.count("*").alias("n"))
    return d.select("display_name", X.has_letter(F.col("display_name")).alias("has_letter"), X.is_name_shaped(F.col("display_name")).alias("name_shaped"), "n")


@query(
    _LINES
    + f""", h as (select doc_id, {_strip('line')} h, min(line_no) f from l where {_strip('line')} <> '' group by 1, 2)
select d.doc_id, string_agg(h.h, ', ' order by h.f) prompt from d left join h using (doc_id) group by 1"""
)
def prompt_dedupe(spark, folder):
    """Every line of a text once, joined."""
    d = table(spark, folder, "documents").where("text is not null")
    return d.select("doc_id", X.prompt(X.lines(F.col("text"))).alias("prompt"))


@query(
    """with q as (select vec_id, [embedding[1], embedding[3], embedding[5], embedding[7]]::double[] xs, [embedding[2], embedding[4], embedding[6], embedding[8]]::double[] ys from embeddings)
select vec_id, list_min(xs) "left", list_min(ys) top, list_max(xs) - list_min(xs) width, list_max(ys) - list_min(ys) height from q"""
)
def quad_to_bbox(spark, folder):
    """Boxes of four points."""
    e = F.col("embedding")
    quad = F.array(*[F.array(e[2 * i].cast("double"), e[2 * i + 1].cast("double")) for i in range(4)])
    return table(spark, folder, "embeddings").select("vec_id", X.box_of(quad).alias("b")).select("vec_id", "b.*")


@query(
    """with s as (select p_partkey, p_size * 40 w0, p_size * 22 h0 from part),
b as (select *, cast(floor(w0 * 0.22::double) as integer) w, cast(floor(h0 * 0.22::double) as integer) h from s),
t as (select *, greatest(1, cast(floor(h * 0.4::double) as integer)) label_h, greatest(1, cast(floor(h0 * 0.18::double) as integer)) tile_h from b)
select p_partkey, w0 - w x, 0 y, w, h, h - label_h label_y, label_h, greatest(0, 5 + h0 - tile_h) tile_y, greatest(1, cast(floor(w0 * 0.65::double) as integer)) tile_w, 5 + h0 - greatest(0, 5 + h0 - tile_h) tile_h from t"""
)
def badge_geometry(spark, folder):
    """Where badge and name labels lie in frames of different sizes."""
    w, h = (F.col("p_size") * 40).cast("int"), (F.col("p_size") * 22).cast("int")
    d = table(spark, folder, "part").select("p_partkey", X.badge_geometry(w, h, Layout()).alias("b"), X.tile_label_geometry(F.lit(5), F.lit(5), w, h, Layout()).alias("t"))
    return d.select("p_partkey", "b.*", F.col("t.y").alias("tile_y"), F.col("t.w").alias("tile_w"), F.col("t.h").alias("tile_h"))


@query(
    "with recursive "
    + T.SQL
    + rf""",
c as (select *, case when signal = 'active_speaker_border' and confidence >= 0.6 then display_name end border, case when signal = 'presentation_badge' and confidence >= 0.6 then display_name end badge,
       {_n_words('display_name')} <= 4 and regexp_matches({_strip('display_name')}, '{_NAME}') shaped, {_strip('display_name')} bare from seen)
select meeting_id, pos, case when border is not null then border when badge is not null then badge when shaped then bare when bare <> '' and upper(bare) <> 'NONE' and regexp_matches(bare, '\p{{L}}') then bare end as name,
       case when border is not null or badge is not null then confidence when shaped then 1.0::double end detection_confidence,
       case when border is not null then 'active_speaker_border' when badge is not null then 'presentation_badge' when shaped then 'layout_heuristic' when bare <> '' and upper(bare) <> 'NONE' and regexp_matches(bare, '\p{{L}}') then 'gpt4o_vision' end source
from c"""
)
def detector_cascade(spark, folder):
    """The name found by the first detector that finds one."""
    d = T.events(spark, folder)
    sure = F.col("confidence") >= 0.6
    border, badge = F.when((F.col("signal") == "active_speaker_border") & sure, F.col("display_name")), F.when((F.col("signal") == "presentation_badge") & sure, F.col("display_name"))
    page = ocr.plain_lines(F.array(F.lit("layout"), F.coalesce("display_name", F.lit(""))))
    found = ocr.display_name(border, F.col("confidence"), badge, F.col("confidence"), page, X.vision_answer(F.col("display_name")))
    return d.select("meeting_id", "pos", found.alias("f")).select("meeting_id", "pos", "f.name", F.col("f.confidence").alias("detection_confidence"), "f.source")


@query(
    "with recursive "
    + T.SQL
    + """, p as (select meeting_id, start_ms // 60000 as "minute", round(avg(confidence), 6) mean, count(*) n from seen group by 1, 2)
select meeting_id, "minute", mean, mean < 0.5 read_again, case when mean < 0.5 then 1 else n end n_lines from p"""
)
def avg_conf_gate(spark, folder):
    """Pages read with low confidence are read again (here by a fallback that finds one line)."""
    line = F.struct(F.col("display_name").alias("text"), F.col("confidence"), F.lit(0.0).alias("left"), F.lit(0.0).alias("top"), F.lit(0.0).alias("width"), F.lit(1.0).alias("height"))
    d = T.events(spark, folder).groupBy("meeting_id", F.expr("start_ms div 60000").alias("minute")).agg(F.collect_list(line).alias("page"))
    d = d.withColumn("mean", F.round(ocr.mean_confidence(F.col("page")), 6))
    # A page is judged by its rounded mean; without any confidence it is not.
    d = d.withColumn("read_again", F.when(F.col("mean").isNotNull(), ocr.needs_fallback(F.col("page"), F.lit(True), F.col("mean"))))
    n_lines = F.size(ocr.after_fallback(F.col("page"), F.col("read_again"), F.array(F.lit("read again")))).cast("bigint")
    return d.select("meeting_id", "minute", "mean", "read_again", n_lines.alias("n_lines"))


@query("select distinct meeting_id, pos, printf('seg_%06d-%06d', cast(round_even(start_s * 100, 0) as bigint), cast(round_even(end_s * 100, 0) as bigint)) segment_id, printf('slide_%06d', cast(round_even(start_s * 100, 0) as bigint)) slide_id from transcript")
def self_describing_ids(spark, folder):
    """Ids made of times."""
    return table(spark, folder, "transcript").select("meeting_id", "pos", X.segment_id(F.col("start_s"), F.col("end_s")).alias("segment_id"), X.slide_id(F.col("start_s")).alias("slide_id")).distinct()


@query("select distinct meeting_id, pos, round(round(start_s + 1e-9, 3) + round(end_s - start_s + 1e-9, 3) + 1e-9, 3) end_s, cast(floor(start_s * 16000) as integer) first_sample, round(cast(floor(start_s * 16000) as integer) / 16000.0::double + 1e-9, 3) first_s from transcript where start_s is not null and end_s is not null")
def derived_end(spark, folder):
    """Ends from rounded start and duration; samples to seconds.

    first_sample is INT as in the SQL while all samples fit into it. After 37 hours of a recording they do not, where
    the SQL has no result; then the whole column is BIGINT.
    """
    s, e = F.col("start_s"), F.col("end_s")
    sample = F.floor(s * 16000)
    d = table(spark, folder, "transcript").where("start_s is not null and end_s is not null")
    if d.where(~sample.between(-(2**31), 2**31 - 1)).isEmpty():
        sample = sample.cast("int")
    return d.select("meeting_id", "pos", X.round3(X.round3(s) + X.round3(e - s)).alias("end_s"), sample.alias("first_sample"), X.round3(X.samples_to_seconds(sample)).alias("first_s")).distinct()


@query("select vec_id, len(embedding[3:10]) n, round(list_sum(embedding[3:10]::double[]), 4) total from embeddings")
def audio_slice(spark, folder):
    """Samples between two times."""
    d = table(spark, folder, "embeddings").select("vec_id", X.audio_slice(F.col("embedding"), F.lit(0.25), F.lit(1.0), 10).alias("s"))
    return d.select("vec_id", F.size("s").cast("bigint").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x.cast("double")), 4).alias("total"))


@query("select event_id, event_type, cast(json_extract(props, '$.k') as integer) k from events")
def json_extract_props(spark, folder):
    """Records in JSON inside a column, read by their schema."""
    return table(spark, folder, "events").select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))
