"""Registered queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemill.config import Config
from sievemill.functions import json_text, text
from sievemill.operators import aggregate, dedup, formatting, generate, joins, pages, sampling, validate
from sievemill.plans import pipeline
from sievemill.session import checkpoint_folder, ship
from sievemill.sources import files, tables
from sievemill.streaming import sessions

CONFIG = Config()
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: The white space of str.strip(), for DuckDB.
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TYPES = "[" + ", ".join(f"'{t}'" for t in tables.TYPES) + "]"
#: Question/answer pairs and documents as pairs, in SQL.
_QA = f"""qa as (select concat(t.conv_id, '_q', t.turn) qa_id, cast(t.conv_id as varchar) article_id, t.text question,
  {_TYPES}[1 + t.turn % 7] question_type, t.next_text answer, d.lang collection, concat('Article ', t.conv_id) article_title, t.conv_id * 1000 + t.turn ord
  from (select *, lead(role) over w next_role, lead(text) over w next_text from conversations window w as (partition by conv_id order by turn)) t
  join documents d on d.doc_id = t.conv_id where t.role = 'user' and t.next_role = 'assistant')"""
_DOCS = "docs as (select concat('d', doc_id) qa_id, cast(doc_id as varchar) article_id, split_part(text, chr(10), 1) question, 'factual' question_type, text answer, source collection, lang article_title, doc_id ord from documents)"
_LENGTH = """case when length(question) < 5 then concat('Question too short: ', length(question), ' < 5') when length(question) > 500 then concat('Question too long: ', length(question), ' > 500')
  when length(answer) < 20 then concat('Answer too short: ', length(answer), ' < 20') when length(answer) > 2000 then concat('Answer too long: ', length(answer), ' > 2000') end"""


def _norm(c: str) -> str:
    return f"lower(regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g'))"


def _query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(ship(spark), sf_dir)
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query(f"with {_DOCS} select qa_id, {_LENGTH} as error from docs")
def length_check(spark, sf_dir):
    return tables.qa_docs(spark, sf_dir).select("qa_id", validate.length_error().alias("error"))


@_query(f"with {_DOCS} select count(*) filter (where error is null) passed, count(*) filter (where error is not null) failed from (select {_LENGTH} as error from docs)")
def length_counts(spark, sf_dir):
    return validate.pass_counts(tables.qa_docs(spark, sf_dir), validate.length_error())


@_query(f"with {_DOCS} select qa_id, row_number() over (partition by {_norm('question')}, {_norm('answer')} order by ord) > 1 as duplicate from docs")
def exact_dedup(spark, sf_dir):
    return dedup.mark_exact(tables.qa_docs(spark, sf_dir), dedup.qa_keys()).select("qa_id", "duplicate")


@_query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by event_id) = 1")
def keep_first_by_id(spark, sf_dir):
    return dedup.keep_first(tables.table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id", "event_type")


@_query("select user_id, max(event_id) event_id, arg_max(event_type, event_id) event_type from events group by user_id")
def last_wins(spark, sf_dir):
    return dedup.last_wins(tables.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@_query(f"with {_QA} select collection as name, count(*) examples, min(ord) first_ord from qa group by 1")
def collection_counts(spark, sf_dir):
    return aggregate.counts(tables.qa_pairs(spark, sf_dir), F.col("collection"))


@_query(f"with {_QA} select question_type as name, count(*) examples, min(ord) first_ord from qa group by 1")
def type_counts(spark, sf_dir):
    return aggregate.counts(tables.qa_pairs(spark, sf_dir), F.col("question_type"))


@_query(f"with {_DOCS} select collection as name, count(*) examples from docs group by 1 order by count(*) desc, min(ord) limit 5")
def top_collections(spark, sf_dir):
    return aggregate.by_count(aggregate.counts(tables.qa_docs(spark, sf_dir), F.col("collection"))).limit(5).select("name", "examples")


@_query(f"with {_QA} select count(*) total_examples, count(distinct article_id) source_articles, count(*) / count(distinct article_id) avg_questions_per_article, sum(length(answer)) / count(*) avg_answer_length from qa")
def metadata_summary(spark, sf_dir):
    return aggregate.averages(tables.qa_pairs(spark, sf_dir))


@_query(
    f"with {_QA} select qa_id, case collection when 'en' then 'seller' when 'de' then 'buyer' when 'fr' then 'missing' else 'default' end prompt_key, "
    f"case collection when 'en' then '{CONFIG.system_prompts['seller']}' when 'de' then '{CONFIG.system_prompts['buyer']}' else '{CONFIG.system_prompts['default']}' end system_prompt from qa"
)
def prompt_lookup(spark, sf_dir):
    qa = tables.qa_pairs(spark, sf_dir)
    return qa.select("qa_id", joins.prompt_key("collection", CONFIG).alias("prompt_key"), joins.system_prompt("collection", CONFIG).alias("system_prompt"))


_NAMES = {"machinery": "Machines", "building": "Buildings"}


@_query("select c_custkey, case lower(c_mktsegment) when 'machinery' then 'Machines' when 'building' then 'Buildings' else concat(upper(left(lower(c_mktsegment), 1)), substr(lower(c_mktsegment), 2)) end as name from customer")
def slug_name(spark, sf_dir):
    c = tables.table(spark, sf_dir, "customer")
    return c.select("c_custkey", text.slug_name(F.lower("c_mktsegment"), _NAMES).alias("name"))


def _grouped(spark, sf_dir) -> DataFrame:
    """Each conversation's user turns as an article's question array."""
    qa = tables.qa_pairs(spark, sf_dir)
    each = F.array_sort(F.collect_list(F.struct("ord", "question", F.col("question_type").alias("type"))))
    return qa.groupBy("article_id").agg(each.alias("questions"), F.min("ord").alias("ord"))


@_query(f"with {_QA} select concat(article_id, '_q', row_number() over (partition by article_id order by ord) - 1) as qa_id, question, question_type, lang as title from qa join documents on doc_id = cast(article_id as bigint)")
def question_explode(spark, sf_dir):
    return joins.work_items(_grouped(spark, sf_dir), tables.article_texts(spark, sf_dir)).select("qa_id", "question", "question_type", "title")


@_query("select l.doc_id, coalesce(d.lang, '') title, coalesce(d.source, '') collection from labels l left join documents d on l.doc_id = d.doc_id")
def result_left_join(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("article_id"))
    return joins.with_article(rows, tables.article_texts(spark, sf_dir)).select(F.col("article_id").cast("long").alias("doc_id"), "title", "collection")


@_query(f"with {_QA}, r as (select case when ord % 11 = 0 then concat('x', qa_id) else qa_id end custom_id, ord % 5 = 0 bad, answer content from qa) select q.qa_id, q.question, q.question_type, r.content, q.article_title from qa q join r on q.qa_id = r.custom_id where not r.bad")
def qa_join(spark, sf_dir):
    """Batch answers joined to the items that were asked: errors and unknown ids are left out."""
    qa = tables.qa_pairs(spark, sf_dir)
    bad = F.col("ord") % 5 == 0
    results = qa.select(F.when(F.col("ord") % 11 == 0, F.concat(F.lit("x"), F.col("qa_id"))).otherwise(F.col("qa_id")).alias("custom_id"), F.when(bad, "refused").alias("error"), F.when(~bad, F.col("answer")).alias("content"))
    return joins.answered(results, qa).select("qa_id", "question", "question_type", "content", "article_title")


@_query("select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def resume_anti(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents")
    return joins.not_done(d.select("doc_id", "lang"), tables.table(spark, sf_dir, "labels"), "doc_id")


@_query(f"with {_DOCS} select qa_id from docs where ({_LENGTH}) is null")
def failed_ids_anti(spark, sf_dir):
    docs = tables.qa_docs(spark, sf_dir)
    failed = docs.filter(validate.length_error().isNotNull()).select("qa_id")
    return joins.not_done(docs.select("qa_id"), failed, "qa_id")


@_query(f"with {_DOCS} select qa_id, ord from docs order by ord limit 100")
def head_limit(spark, sf_dir):
    return sampling.head(tables.qa_docs(spark, sf_dir).select("qa_id", "ord"), 100)


@_query(f"with {_DOCS} select qa_id from docs order by md5(concat('1', qa_id)), ord limit (select greatest(1, cast(floor(count(*) * 0.1::double) as bigint)) from documents)")
def sample_md5(spark, sf_dir):
    return sampling.fixed_sample(tables.qa_docs(spark, sf_dir).select("qa_id", "ord"), 0.1).select("qa_id")


_NUMBERS = r"list_distinct(regexp_extract_all({}, '\$?\d+(?:,\d{{3}})*(?:\.\d+)?%?'))"
_MARKS = ", ".join("'" + m.replace("'", "''") + "'" for m in validate.MARKERS)
_ISSUES = f"""array_to_string(list_concat(
  list_sort(list_filter({_NUMBERS.format('answer')}, lambda x: not list_contains({_NUMBERS.format('other')}, x) and x not in ('1', '2', '3', '4', '5'))),
  list_transform(list_filter([{_MARKS}], lambda m: contains(lower(answer), lower(m))), lambda m: 'marker: ' || m)), '; ')"""
#: Each document as an answer to the article of the next smaller id.
_OTHER = "other as (select doc_id, text answer, coalesce(lag(text) over (order by doc_id), '') other from documents)"


#: Ids of a range within which the preceding id is looked up; ranges, at most.
ID_RANGE, ID_RANGES = 50_000, 1000


def _preceding(ids: DataFrame) -> DataFrame:
    """(doc_id, before): each distinct id with the next smaller one, null for the smallest. Ids are taken in ranges, each with the largest id below it."""
    n = min(ID_RANGES, ids.count() // ID_RANGE + 1)
    bounds = ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.5 / n) if n > 1 else []
    below = F.array(*map(F.lit, bounds)).cast("array<double>")
    placed = ids.distinct().withColumn("range", F.size(F.filter(below, lambda b: b <= F.col("doc_id").cast("double"))))
    largest = sorted((r["range"], r["largest"]) for r in placed.groupBy("range").agg(F.max("doc_id").alias("largest")).collect())  # ID_RANGES rows at most
    carried = [(r, low) for (r, _), (_, low) in zip(largest[1:], largest, strict=False)]
    carry = F.broadcast(ids.sparkSession.createDataFrame(carried, "range int, carried long"))
    own = F.lag("doc_id").over(Window.partitionBy("range").orderBy("doc_id"))
    return placed.withColumn("own", own).join(carry, "range", "left").select("doc_id", F.coalesce("own", "carried").alias("before"))


def _answers(spark, sf_dir) -> DataFrame:
    """doc_id, answer, other: the text of the row before by id, and by text among rows that repeat an id; '' for the first. Ids are never null."""
    d = tables.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("answer"))
    same = Window.partitionBy("doc_id").orderBy("answer")
    rows = d.withColumns({"place": F.row_number().over(same), "copy": F.lag("answer").over(same)})
    last = d.groupBy("doc_id").agg(F.max("answer").alias("last")).withColumnRenamed("doc_id", "before")
    before = _preceding(d.select("doc_id")).join(last, "before").select("doc_id", "last")
    other = F.when(F.col("place") > 1, F.col("copy")).otherwise(F.col("last"))
    return rows.join(before, "doc_id", "left").select("doc_id", "answer", F.coalesce(other, F.lit("")).alias("other"))


@_query(f"with {_OTHER} select doc_id, {_ISSUES} as issues from other")
def grounding(spark, sf_dir):
    return _answers(spark, sf_dir).select("doc_id", F.array_join(validate.grounding_issues("answer", "other"), "; ").alias("issues"))


@_query(f"with {_OTHER} select count(*) filter (where issues = '') passed, count(*) filter (where issues <> '') failed, round(count(*) filter (where issues = '') / count(*), 6) rate from (select {_ISSUES} as issues from other)")
def grounding_rate(spark, sf_dir):
    size = F.size(validate.grounding_issues("answer", "other"))
    counted = _answers(spark, sf_dir).agg(F.count_if(size == 0).alias("passed"), F.count_if(size > 0).alias("failed"))
    return counted.withColumn("rate", F.round(aggregate.pass_rate(F.col("passed"), F.col("failed")), 6))


_STARTS = " or ".join(f"starts_with(q, '{w}')" for w in validate.OPENERS)


@_query(f"with {_DOCS}, n as (select qa_id, {_norm('question')} q from docs) select qa_id, case when q = '' then 'Empty question' when not ends_with(q, '?') and not ({_STARTS}) and length(q) > 30 then 'Long question should end with ''?''' end as error from n")
def question_format(spark, sf_dir):
    return tables.qa_docs(spark, sf_dir).select("qa_id", validate.question_error("question").alias("error"))


@_query(f"with {_DOCS}, n as (select qa_id, length({_norm('question')}) ln from docs), l as (select ln, count(*) n from n group by ln), b as (select x.ln, sum(y.n) - 1 partners from l x join l y on case when x.ln + y.ln = 0 then true else 2.0::double * least(x.ln, y.ln) / (x.ln + y.ln) >= 0.95::double end group by x.ln) select qa_id, cast(partners as bigint) partners from n join b using (ln)")
def length_band_pairs(spark, sf_dir):
    """How many other questions each one's length lets be similar. Lengths are compared, not rows."""
    n = tables.qa_docs(spark, sf_dir).select("qa_id", F.length(text.normalise("question")).alias("ln"))
    lengths = n.groupBy("ln").agg(F.count("*").alias("n"))
    other = lengths.select(F.col("ln").alias("other"), F.col("n").alias("m"))
    band = lengths.join(other, dedup.length_bound(F.col("ln"), F.col("other"), 0.95)).groupBy("ln").agg((F.sum("m") - 1).alias("partners"))
    return n.join(band, "ln").select("qa_id", "partners")


@_query()
def near_dup_pairs(spark, sf_dir):
    """Similar questions as pairs of classes of equal ones; question_classes has the members."""
    return dedup.class_pairs(tables.qa_docs(spark, sf_dir))


@_query(f"with {_DOCS}, n as (select ord, {_norm('question')} q from docs) select ord, min(ord) over (partition by q) as class_ord from n")
def question_classes(spark, sf_dir):
    return dedup.question_classes(tables.qa_docs(spark, sf_dir))


@_query()
def near_dup_summary(spark, sf_dir):
    return dedup.near_summary(tables.qa_pairs(spark, sf_dir))[1]


@_query()
def dedup_full(spark, sf_dir):
    return dedup.deduplicate(tables.qa_pairs(spark, sf_dir))[1]


_MESSAGES = "c as (select conv_id, list(role order by turn) r, list(text order by turn) t from conversations group by conv_id)"


@_query(
    f"with {_MESSAGES} select conv_id, case when len(r) <> 3 then 'Messages should be a list of 3 items (system, user, assistant)' when r[1] <> 'system' then concat('Message 0 should have role ''system'', got ''', r[1], '''') when t[1] = '' then 'Message 0 has empty content'"
    " when r[2] <> 'user' then concat('Message 1 should have role ''user'', got ''', r[2], '''') when t[2] = '' then 'Message 1 has empty content' when r[3] <> 'assistant' then concat('Message 2 should have role ''assistant'', got ''', r[3], '''') when t[3] = '' then 'Message 2 has empty content' end as error from c"
)
def message_schema(spark, sf_dir):
    return tables.conversations(spark, sf_dir).select("conv_id", validate.message_error("messages").alias("error"))


@_query(_SQL["message_schema"])
def line_check(spark, sf_dir):
    lines = tables.conversations(spark, sf_dir).select("conv_id", F.to_json(F.struct("messages")).alias("value"))
    return validate.line_errors(lines).select("conv_id", "error")


@_query(
    f"with {_QA}, m as (select qa_id, unnest([0, 1, 2]) idx, question, answer, collection from qa) select qa_id, idx, ['system', 'user', 'assistant'][idx + 1] as role, "
    f"case idx when 1 then question when 2 then answer else case collection when 'en' then '{CONFIG.system_prompts['seller']}' when 'de' then '{CONFIG.system_prompts['buyer']}' else '{CONFIG.system_prompts['default']}' end end as content from m"
)
def training_example(spark, sf_dir):
    m = tables.qa_pairs(spark, sf_dir).select("qa_id", F.posexplode(formatting.messages(CONFIG)).alias("idx", "m"))
    return m.select("qa_id", "idx", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@_query(f"with {_QA} select qa_id as custom_id, 'POST' as method, concat('Q: ', question, ' {{ok}}') as content, 0.3::double as temperature, 500 as max_tokens from qa")
def batch_request(spark, sf_dir):
    prompt = text.fill("Q: {question} {{ok}}", question=F.col("question"))
    line = F.to_json(formatting.batch_request(F.col("qa_id"), prompt, "m", F.lit(0.3), F.lit(500)))
    got = tables.qa_pairs(spark, sf_dir).select(line.alias("j"))
    read = lambda p: F.get_json_object("j", p)
    return got.select(read("$.custom_id").alias("custom_id"), read("$.method").alias("method"), read("$.body.messages[0].content").alias("content"), read("$.body.temperature").cast("double").alias("temperature"), read("$.body.max_tokens").cast("int").alias("max_tokens"))


@_query("select cast(event_id as varchar) as custom_id, case when event_id % 10 = 0 then '\"bad\"' end as error, case when event_id % 10 <> 0 then event_type end as content from events")
def batch_result_parse(spark, sf_dir):
    bad = F.col("event_id") % 10 == 0
    body = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(F.col("event_type").alias("content")).alias("message"))).alias("choices")).alias("body")))
    line = F.concat(F.lit('{"custom_id": "'), F.col("event_id"), F.lit('", "error": '), F.when(bad, '"\\"bad\\""').otherwise("null"), F.lit(', "response": '), body, F.lit("}"))
    return files.batch_results(tables.table(spark, sf_dir, "events").select(line.alias("value")))


@_query(f"with {_QA} select qa_id, question, question_type as type from qa")
def parse_questions(spark, sf_dir):
    """Each question as a model's fenced answer, read back."""
    body = F.to_json(F.array(F.struct("question", F.col("question_type").alias("type"))))
    reply = F.concat(F.lit("Here they are:\n```json\n"), body, F.lit("\n```\nDone."))
    got = tables.qa_pairs(spark, sf_dir).select("qa_id", F.explode(json_text.questions_of(reply)).alias("q"))
    return got.select("qa_id", F.col("q.question").alias("question"), F.col("q.type").alias("type"))


_LINK = "concat('/articles/', p_partkey, '-', replace(lower(p_name), ' ', '-'), case p_partkey % 3 when 0 then '?a=1?b' when 1 then '#top' else '' end)"


@_query(f"select p_partkey, cast(p_partkey as varchar) as id, replace(lower(p_name), ' ', '-') as slug, concat('https://help.example.com', split_part({_LINK}, '?', 1)) as url from part")
def url_parse(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part")
    tail = F.when(F.col("p_partkey") % 3 == 0, "?a=1?b").when(F.col("p_partkey") % 3 == 1, "#top").otherwise("")
    href = F.concat(F.lit("/articles/"), F.col("p_partkey"), F.lit("-"), F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), tail)
    full = text.absolute(href, CONFIG.scraping.origin)
    return p.select("p_partkey", text.url_part(full, "articles", "id").alias("id"), text.url_part(full, "articles", "slug").alias("slug"), text.strip_query(full).alias("url"))


@_query("select page_id, split_part(url, '?', 1) as url from pages")
def strip_query(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select("page_id", text.strip_query("url").alias("url"))


_MD = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\\n{{3,}}', chr(10) || chr(10), 'g'), '<[^>]+>', '', 'g'), '\\[([^\\]]+)\\]\\(javascript:[^)]*\\)', '\\1', 'g'), 'Skip to main content\\n*', '', 'g'), '^{_WS}+|{_WS}+$', '', 'g')"


@_query(f"select doc_id, md5({_MD}) as digest, length({_MD}) as n from (select doc_id, concat('Skip to main content', chr(10), chr(10), '<b>', replace(text, chr(10), chr(10) || chr(10) || chr(10)), '</b> [go](javascript:x)  ', chr(10)) t from documents)")
def clean_markdown(spark, sf_dir):
    t = F.concat(F.lit("Skip to main content\n\n<b>"), F.replace("text", F.lit("\n"), F.lit("\n\n\n")), F.lit("</b> [go](javascript:x)  \n"))
    clean = text.clean_markdown(t)
    return tables.table(spark, sf_dir, "documents").select("doc_id", F.md5(clean.cast("binary")).alias("digest"), F.length(clean).cast("long").alias("n"))


@_query("select conv_id, string_agg(text, '' order by turn) as response from conversations group by conv_id")
def response_fold(spark, sf_dir):
    return aggregate.fold_fragments(tables.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@_query("select count(*) total, count(*) filter (where error is null) completed, count(*) filter (where error is not null) failed from (select case when event_id % 10 = 0 then 'bad' end as error from events)")
def request_counts(spark, sf_dir):
    return aggregate.request_counts(batch_result_parse(spark, sf_dir))


_COMMANDS = """c as (select cast(conv_id as varchar) session_id, turn seq, case when role = 'user' and turn % 5 = 2 then 'clear' when role = 'user' and turn % 7 = 4 then 'system' when role = 'user' then 'message' else 'completion' end cmd,
  ['seller', 'unknown', 'buyer'][1 + conv_id % 3] k from conversations), s as (select *, cmd = 'system' and k <> 'unknown' sw from c), p as (select *, sum(case when cmd = 'clear' or sw then 1 else 0 end) over (partition by session_id order by seq) part from s)"""


@_query(
    f"with {_COMMANDS}, q as (select *, max(part) over (partition by session_id) lastp from p) select session_id, coalesce(arg_max(case when sw then k end, case when sw then seq end), 'default') system_prompt_key, count(*) filter (where cmd in ('message', 'completion') and part = lastp) message_count, bool_or(sw or cmd in ('message', 'completion', 'clear', 'error')) exists_ from q group by session_id"
)
def session_state(spark, sf_dir):
    return sessions.replay(tables.session_commands(spark, sf_dir), CONFIG)


@_query(f"with {_COMMANDS} select session_id, cast(seq as bigint) seq, case cmd when 'clear' then 'cleared' when 'message' then 'accepted' when 'completion' then 'done' else case when sw then 'switched' else 'rejected' end end as event from s")
def session_events(spark, sf_dir):
    """The stream of commands, read as it lies, through sessions kept as state."""
    at = checkpoint_folder(spark, "session_events")
    commands = tables.session_commands(spark, sf_dir)
    commands.select("session_id", F.col("seq").cast("long").alias("seq"), "cmd", "arg").write.parquet(f"{at}/in")
    stream = spark.readStream.schema("session_id string, seq long, cmd string, arg string").parquet(f"{at}/in")
    query = sessions.events(stream, CONFIG).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(sessions.EVENT).parquet(f"{at}/out").select("session_id", "seq", "event")


@_query("select page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1) like '%&%' as escaped, contains(html, '<img') has_images, contains(html, '<table') has_tables, contains(html, '<video') has_video from pages")
def page_flags(spark, sf_dir):
    p = _pages(spark, sf_dir)
    read = pages.articles(p).select(F.col("ord").alias("page_id"), "metadata.has_images", "metadata.has_tables", "metadata.has_video")
    raw = tables.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<h1>(.*?)</h1>", 1).contains("&").alias("escaped"))
    return raw.join(read, "page_id")


def _pages(spark, sf_dir) -> DataFrame:
    p = tables.table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").cast("string").alias("id"), "url", F.lit("").alias("title"), F.lit("Help").alias("collection"), F.lit("1").alias("collection_id"), F.col("page_id").alias("ord"), "html")


@_query(f"""with t as (select doc_id, regexp_replace(regexp_replace(concat(text, ' [go](http://x/y) | Acme Help Center x'), '\\s*\\|\\s*Acme Help Center.*$', ''), '\\[([^\\]]+)\\]\\([^)]*\\)', '\\1', 'g') raw from documents),
  c as (select doc_id, regexp_replace(regexp_replace(raw, '{_WS}+', ' ', 'g'), '^{_WS}+|{_WS}+$', '', 'g') clean from t)
  select doc_id, md5(clean) digest, case when clean = '' then 0 else len(string_split(clean, ' ')) end n_words from c""")
def clean_text(spark, sf_dir):
    """Titles without their site, links as their text, white space collapsed, words counted."""
    whole = F.concat("text", F.lit(" [go](http://x/y) | Acme Help Center x"))
    clean = text.collapse_spaces(text.unlink_markdown(text.strip_title(whole, "Acme Help Center")))
    return tables.table(spark, sf_dir, "documents").select("doc_id", F.md5(clean.cast("binary")).alias("digest"), text.word_count(clean).alias("n_words"))


_HREF = "concat(case p_partkey % 3 when 0 then '/' when 1 then 'https://h.example/' else 'x/' end, case p_partkey % 2 when 0 then 'collections/' else 'articles/' end, p_partkey)"


@_query(f"select p_partkey, contains(h, '/collections/') and (starts_with(h, 'http') or starts_with(h, '/')) as is_collection, contains(h, '/articles/') as is_article from (select p_partkey, {_HREF} h from part)")
def link_kinds(spark, sf_dir):
    k = F.col("p_partkey")
    href = F.concat(F.when(k % 3 == 0, "/").when(k % 3 == 1, "https://h.example/").otherwise("x/"), F.when(k % 2 == 0, "collections/").otherwise("articles/"), k.cast("string"))
    return tables.table(spark, sf_dir, "part").select("p_partkey", text.is_link(href, "collections").alias("is_collection"), text.is_link(href, "articles").alias("is_article"))


@_query("select event_type as shown, count(*) as n from events group by 1 union all select 'Error: down', count(*) from events having count(*) > 0")
def sse_decode(spark, sf_dir):
    """What a client shows of event streams: one content and one error each; a bad line, an end and a cut-off line show nothing."""
    stream = F.concat(F.lit('data: {"content": "'), F.col("event_type"), F.lit('"}\n\ndata: {bad\ndata: {"error": "down"}\n\ndata: {"complete": true}\n\ndata: {"content": "tail"}'))
    return files.sse_contents(tables.table(spark, sf_dir, "events").select(stream.alias("value"))).groupBy("shown").agg(F.count("*").alias("n"))


def _filled(template: str, **values: str) -> str:
    """A template as an SQL expression."""
    parts = ["''"]
    for token in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        literal = token[0] if token in ("{{", "}}") else token
        parts.append(values[token[1:-1]] if re.fullmatch(r"\{\w+\}", token) else "'" + literal.replace("'", "''") + "'")
    return f"concat({', '.join(parts)})"


_CAP = f"substr(text, 1, {CONFIG.generation.content_chars})"
_ASK = _filled(generate.QUESTION_TEMPLATE, title="lang", collection="source", description="'about'", content=_CAP)
_ANSWER = _filled(generate.ANSWER_TEMPLATE, title="lang", collection="source", content=_CAP, question="concat('What of ', doc_id, '?')")


@_query(f"select doc_id, md5({_ASK}) as asked, length({_ASK}) as n_asked, md5({_ANSWER}) as answered, length({_ANSWER}) as n_answered from documents")
def prompts(spark, sf_dir):
    """Prompts of whole documents, with their content cut where the prompt's limit is."""
    a = tables.article_texts(spark, sf_dir).withColumns({"description": F.lit("about"), "question": F.concat(F.lit("What of "), F.col("ord"), F.lit("?"))})
    ask, answer = generate.question_prompt(CONFIG), generate.answer_prompt(CONFIG)
    digest = lambda c: F.md5(c.cast("binary"))
    return a.select(F.col("ord").alias("doc_id"), digest(ask).alias("asked"), F.length(ask).cast("long").alias("n_asked"), digest(answer).alias("answered"), F.length(answer).cast("long").alias("n_answered"))


@_query(f"with m as (select cast(doc_id as varchar) article_id, substr(md5({_ASK}), 1, 6) mark from documents) select article_id, pos, concat('What does ', mark, ' say about point ', pos, '?') as question, ['factual', 'procedural', 'eligibility', 'consequence'][pos + 1] as type from (select article_id, mark, unnest([0, 1, 2, 3]) pos from m)")
def generated_questions(spark, sf_dir):
    a = tables.article_texts(spark, sf_dir).withColumn("description", F.lit("about"))
    got = generate.generate_questions(a, generate.StubProvider(), CONFIG)
    return got.select("article_id", F.posexplode("questions").alias("pos", "q")).select("article_id", "pos", "q.question", "q.type")


@_query("select l.doc_id as id, 0 as run, cast(l.doc_id as varchar) as label from labels l union all select d.doc_id, 1, d.lang from documents d where d.doc_id not in (select doc_id from labels)")
def resume_merge(spark, sf_dir):
    """Rows done before come first, then what was left to do."""
    done = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("label"), F.col("doc_id").alias("ord"))
    work = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), F.col("doc_id").alias("ord"))
    return joins.merge_resumed(done, joins.not_done(work, done, "id")).select("id", F.col("ord.run").alias("run"), "label")


@_query("select row_number() over (order by ps) - 1 as ord, prompt_key, model_id from (select unnest([" + ", ".join(f"'{k}'" for k in CONFIG.system_prompts) + "]) prompt_key, unnest(range(" + str(len(CONFIG.system_prompts)) + f")) ps, '{CONFIG.service.model}' model_id)")
def prompt_listing(spark, sf_dir):
    return sessions.listings(spark, CONFIG).withColumn("ord", F.col("ord").cast("long"))


@_query()
def html_extract(spark, sf_dir):
    a = pages.articles(_pages(spark, sf_dir))
    return a.select("article_id", "title", "description", F.length("content.plain_text").alias("n_chars"), "metadata.word_count", F.size("content.sections").alias("n_sections"), F.size("related_articles").alias("n_related"), F.md5(F.col("content.markdown").cast("binary")).alias("markdown_md5"))


@_query()
def sections(spark, sf_dir):
    a = pages.articles(_pages(spark, sf_dir))
    return a.select("article_id", F.posexplode("content.sections").alias("pos", "s")).select("article_id", "pos", "s.heading", "s.level", F.length("s.content").alias("n_chars"))


@_query("""with l as (select url page_url, regexp_extract_all(html, '<a href="/([^"]*)">', 1) h, regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1) t from pages)
  select page_url, pos, concat('/collections/7-', h[pos + 1]) as href, replace(t[pos + 1], '&amp;', '&') as text from (select *, unnest(range(len(h))) pos from l)""")
def collection_links(spark, sf_dir):
    p = tables.table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("ord"), F.replace("html", F.lit('href="/'), F.lit('href="/collections/7-')).alias("html"))
    return pages.page_links(p, "collections").select("page_url", F.col("pos").cast("long").alias("pos"), "href", "text")


@_query()
def generated_pairs(spark, sf_dir):
    articles = pages.articles(_pages(spark, sf_dir))
    return pipeline.articles_to_pairs(articles, generate.StubProvider(), CONFIG).select("qa_id", "article_id", "question", "question_type", "answer", "collection", "article_title")


@_query()
def training_set(spark, sf_dir):
    """The flagship: pairs that pass, as training examples."""
    return pipeline.training_set(tables.qa_pairs(spark, sf_dir), CONFIG).select("qa_id", F.to_json("messages").alias("messages"))


@_query()
def quality_report(spark, sf_dir):
    qa = tables.qa_pairs(spark, sf_dir)
    out = pipeline.validate_set(qa, tables.article_texts(spark, sf_dir), formatting.example_lines(qa, CONFIG), datetime(2000, 1, 1), CONFIG)
    r = out.report
    row = (r["total_examples_generated"], r["examples_after_validation"], *r["removal_reasons"].values(), r["semantic_checks_sample"]["sample_size"], r["semantic_checks_sample"]["grounding_pass_rate"], r["recommendations"][0])
    return spark.createDataFrame([row], "total long, final long, exact long, near long, length_invalid long, sample_size long, grounding_pass_rate double, recommendation string")


_FRAGMENTS = "select conv_id session_id, turn seq, text content from conversations"


@_query(f"with f as ({_FRAGMENTS}), l as (select session_id, max(seq) m from f group by 1) select cast(session_id as varchar) session_id, seq, 'message' as event from f union all select cast(session_id as varchar), m + 1, 'done' from l")
def token_relay(spark, sf_dir):
    c = tables.table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("seq"), F.col("text").alias("content"), F.lit(None).cast("string").alias("error"))
    return sessions.relay(c).select("session_id", "seq", "event")


@_query("select conv_id, turn, case when turn % 4 = 0 then 'exit' when turn % 4 = 1 then 'clear' when turn % 4 = 2 then 'system' else 'message' end as cmd, case when turn % 4 = 2 then 'buyer' when turn % 4 = 3 then '/system' end as arg from conversations")
def command_parse(spark, sf_dir):
    line = F.element_at(F.array(F.lit(" /QUIT "), F.lit("/Clear\n"), F.lit("/system buyer"), F.lit("\t/system ")), (F.col("turn") % 4 + 1).cast("int"))
    return tables.table(spark, sf_dir, "conversations").select("conv_id", "turn", sessions.command_of(line).alias("c")).select("conv_id", "turn", "c.cmd", "c.arg")
