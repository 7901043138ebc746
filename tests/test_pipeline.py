import hashlib
import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from sievemill import config as settings
from sievemill.config import Config
from sievemill.operators import aggregate, formatting, generate, joins
from sievemill.plans import pipeline
from sievemill.sources import files, http, tables
from sievemill.streaming import incremental, sessions

QA = "qa_id string, article_id string, question string, question_type string, answer string, collection string, article_title string, ord long"


def pairs(spark, rows):
    return spark.createDataFrame([(f"a_q{i}", "a", q, t, a, c, "T", i) for i, (q, t, a, c) in enumerate(rows)], QA)


def test_json_files_keep_their_order(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"article_id": str(i), "title": "é"} for i in (3, 1, 2)], indent=2))
    got = files.read_json_array(spark, str(tmp_path / "a.json"), "article_id: string, title: string").orderBy("ord").collect()
    assert [(r.article_id, r.ord) for r in got] == [("3", 0), ("1", 1), ("2", 2)]
    (tmp_path / "q.json").write_text(json.dumps({"z": {"article_id": "z", "title": "t", "collection": "c", "questions": [{"question": "q", "type": "f"}]}, "b": {"questions": []}}))
    got = files.read_questions(spark, str(tmp_path / "q.json")).orderBy("ord").collect()
    assert [r.key for r in got] == ["z", "b"] and got[0].questions[0].question == "q"


def test_lines_are_written_in_order(spark, tmp_path):
    qa = pairs(spark, [("q0?", "f", "é", "en"), ("q1?", "f", "b", "none")])
    files.write_lines(formatting.example_lines(qa.repartition(3), Config()), str(tmp_path / "out"))
    part = [f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]
    lines = (tmp_path / "out" / part[0]).read_text().split("\n")[:-1]
    prompts = Config().system_prompts
    want = [{"messages": [{"role": "system", "content": s}, {"role": "user", "content": q}, {"role": "assistant", "content": a}]} for s, q, a in ((prompts["seller"], "q0?", "é"), (prompts["default"], "q1?", "b"))]
    assert lines == [json.dumps(w) for w in want]


def test_prompt_falls_back_twice(spark):
    qa = pairs(spark, [("q", "f", "a", c) for c in ("en", "fr", "xx", None)])
    got = [r.p for r in qa.orderBy("ord").select(joins.system_prompt("collection", Config()).alias("p")).collect()]
    p = Config().system_prompts
    assert got == [p["seller"], p["default"], p["default"], p["default"]]


def test_batch_results(spark):
    lines = [json.dumps({"custom_id": "1", "error": None, "response": {"body": {"choices": [{"message": {"content": "ok"}}]}}}), "", json.dumps({"custom_id": "2", "error": {"code": 5}}), json.dumps({"custom_id": "3", "response": {"body": {"choices": [{"message": {"content": ""}}]}}})]
    got = files.batch_results(spark.createDataFrame([(x,) for x in lines], "value string")).orderBy("custom_id").collect()
    assert [(r.custom_id, r.error is None, r.content) for r in got] == [("1", True, "ok"), ("2", False, None), ("3", True, "")]
    assert tuple(aggregate.request_counts(spark.createDataFrame([(r.custom_id, r.error) for r in got], "i string, error string")).first()) == (3, 2, 1)


def test_event_stream_text(spark):
    text = 'event: message\ndata: {"content": "a"}\ndata: no\ndata: {"content": ""}\ndata: {"error": "x"}\ndata: {"content": "cut"}'
    got = files.sse_contents(spark.createDataFrame([(text,)], "value string")).orderBy("pos").collect()
    assert [r.shown for r in got] == ["a", "Error: x"]


def test_work_items_and_resume(spark):
    articles = spark.createDataFrame([("a", "old", "c", "m", 0), ("a", "new", "c", "m", 1)], "article_id string, title string, collection string, markdown string, ord long")
    questions = spark.createDataFrame([("a", [("q0", "t", None), ("q1", None, None)], 0), ("gone", [("x", "t", None)], 1)], "article_id string, questions array<struct<question: string, type: string, key_info_needed: string>>, ord long")
    items = joins.work_items(questions, articles)
    assert [(r.qa_id, r.question_type, r.title) for r in items.orderBy("ord").collect()] == [("a_q0", "t", "new"), ("a_q1", "unknown", "new")]
    done = items.filter("qa_id = 'a_q0'")
    assert [r.qa_id for r in joins.not_done(items, done, "qa_id").collect()] == ["a_q1"]
    assert [r.qa_id for r in joins.merge_resumed(done, items.filter("qa_id = 'a_q1'")).orderBy("ord").collect()] == ["a_q0", "a_q1"]
    results = spark.createDataFrame([("a_q1", None, " x "), ("a_q0", "{}", ""), ("who", None, "y")], "custom_id string, error string, content string")
    got = generate.answers_from_batch(results.filter("custom_id <> 'a_q0'").union(results.limit(0)), items).collect()
    assert [(r.qa_id, r.answer, r.article_title) for r in got] == [("a_q1", "x", "new")]


def test_completion_retries_with_backoff():
    waits, tries = [], []

    class Flaky:
        def complete(self, prompt, temperature, max_tokens):
            tries.append(1)
            raise OSError

    assert generate.complete(Flaky(), "p", sleep=waits.append) is None
    assert len(tries) == 3 and waits == [5.0, 10.0]


def test_batch_states():
    class Service:
        def __init__(self, *states):
            self.states = list(states)

        def status(self, batch_id):
            return {"status": self.states.pop(0) if len(self.states) > 1 else self.states[0], "output_file_id": "o"}

    clock = iter(range(0, 10**9, 50_000)).__next__
    wait = lambda *s: generate.wait_for_batch(Service(*s), "b", clock=clock, sleep=lambda x: None)["status"]
    assert [wait("validating", "completed"), wait("failed"), wait("expired"), wait("in_progress")] == ["completed", "failed", "expired", "timeout"]


def test_generation_in_both_modes_agree(spark, tmp_path):
    articles = spark.createDataFrame([("1", "T1", "en", "", "text 10", 0), ("2", "T2", "de", None, "text", 1)], "article_id string, title string, collection string, description string, markdown string, ord long")
    cfg = Config()
    direct = generate.generate_questions(articles, generate.StubProvider(), cfg)
    lines = generate.requests(articles, "article_id", generate.question_prompt(cfg), cfg, 0.8, 1000)
    batch = generate.run_batch(lines, str(tmp_path / "requests"), generate.StubBatchService(str(tmp_path)))
    parsed = generate.questions_from(batch.select(F.col("custom_id").alias("article_id"), F.col("content").alias("response")), batch=True)
    assert {(r.article_id, str(r.questions)) for r in direct.collect()} == {(r.article_id, str(r.questions)) for r in parsed.collect()}
    assert generate.generate_answers(joins.work_items(direct, articles), generate.StubProvider(), cfg).count() == 8


def test_report_and_metadata(spark):
    rows = [("What is the fee?", "f", "The fee is 10 dollars a year.", "en"), ("What is the fee?", "f", "the fee is 10 dollars a year. ", "en"), ("What is the fee??", "g", "It is 10 dollars, I think so.", "de"), ("abc", "f", "It is free of any charge here.", "en")]
    qa = pairs(spark, rows)
    articles = spark.createDataFrame([("a", "fee: 10", 0)], "article_id string, plain_text string, ord long")
    now = datetime(2020, 1, 2)
    cfg = settings.from_dict({"validation": {"semantic_sample_rate": 1.0}})
    out = pipeline.validate_set(qa, articles, formatting.example_lines(qa, cfg), now, cfg)
    r = out.report
    assert r["removal_reasons"] == {"duplicate_exact": 1, "duplicate_near": 1, "content_length_invalid": 1}
    assert r["examples_after_validation"] == 1 and [x.qa_id for x in out.pairs.collect()] == ["a_q0"]
    assert r["automated_checks"]["json_validity"] == {"passed": 4, "failed": 0} and r["semantic_checks_sample"]["grounding_pass_rate"] == 1.0
    assert r["recommendations"] == ["All checks passed. Dataset is ready for fine-tuning."]
    m = pipeline.metadata(qa, "x.jsonl", now)
    assert m["collections_covered"] == [{"name": "en", "examples": 3}, {"name": "de", "examples": 1}] and m["question_type_distribution"] == {"f": 3, "g": 1}
    empty = pipeline.metadata(qa.limit(0), "x", now)
    assert empty["avg_questions_per_article"] == 0 and empty["avg_answer_length_chars"] == 0


def test_grounding_issues_come_in_the_order_of_the_sample(spark):
    rows = [(f"What is fee {i}?", "f", f"It is {100 + i} dollars a year, that is sure.", "en") for i in range(30)]
    qa = pairs(spark, rows)
    articles = spark.createDataFrame([("a", "no numbers", 0)], "article_id string, plain_text string, ord long")
    cfg = settings.from_dict({"validation": {"semantic_sample_rate": 0.5}})
    got = pipeline.validate_set(qa, articles, formatting.example_lines(qa, cfg), datetime(2020, 1, 2), cfg, seed="7").report["semantic_checks_sample"]
    drawn = sorted((r.qa_id for r in qa.select("qa_id").collect()), key=lambda i: hashlib.md5(f"7{i}".encode()).hexdigest())
    assert got["sample_size"] == 15 and [x["qa_id"] for x in got["grounding_issues"]] == drawn[:10]


def test_recommendations():
    assert aggregate.recommendations(0.94, 6, 5) == ["Grounding pass rate is 94.0%. Review flagged examples.", "High duplicate count. Consider reviewing question generation prompts."]


def test_config_reads_the_last_section(tmp_path):
    (tmp_path / "c.yaml").write_text("openai:\n  model: m\nvalidation:\n  min_answer_chars: 1\nvalidation:\n  min_answer_chars: 2\nunknown: 1\nfinetuning:\n  hyperparameters:\n    n_epochs: auto\n    batch_size: 4\n")
    c = settings.load(str(tmp_path / "c.yaml"))
    assert (c.service.model, c.validation.min_answer_chars) == ("m", 2)
    assert generate.finetune_request(c.finetuning, "f")["hyperparameters"] == {"batch_size": 4}
    assert "hyperparameters" not in generate.finetune_request(Config().finetuning, "f")


def test_checkpoints(tmp_path):
    path = str(tmp_path / "x" / "c.json")
    assert files.load_checkpoint(path) == {}
    files.save_checkpoint(path, "answers", datetime(2020, 1, 1), rows=3)
    assert files.resumable(files.load_checkpoint(path), "answers") and not files.resumable({}, "answers") and not files.resumable(files.load_checkpoint(path), "questions")


def test_fetch_and_rate():
    waits = []
    pages = iter([OSError(), OSError(), "page"])

    def get(url):
        x = next(pages)
        if isinstance(x, Exception):
            raise x
        return x

    assert http.fetch("u", get, sleep=waits.append) == "page" and waits == [1.0, 2.0]
    now, slept = iter([0.0, 0.2, 1.0]).__next__, []
    limiter = http.RateLimiter(1.0, now, slept.append)
    limiter.wait(), limiter.wait()
    assert slept == [0.8]


def test_sessions_fold(spark, tmp_path):
    commands = [("s", 1, "message", "hi"), ("s", 2, "completion", "ho"), ("s", 3, "system", "nope"), ("s", 4, "system", "buyer"), ("s", 5, "message", "a"), ("s", 6, "error", "down"), ("t", 1, "system", "nope"), ("u", 1, "clear", None)]
    df = spark.createDataFrame(commands, "session_id string, seq long, cmd string, arg string")
    states = sessions.replay(df)
    assert sessions.inspect(states, "s") == {"exists": True, "system_prompt_key": "buyer", "message_count": 1}
    assert sessions.inspect(states, "t") == {"exists": False} and sessions.inspect(states, "no") == {"exists": False}
    assert sessions.inspect(states, "u") == {"exists": True, "system_prompt_key": "default", "message_count": 0}
    for k in range(2):  # two batches: the state lives on
        df.filter(f"seq {'<=' if k == 0 else '>'} 3").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = sessions.events(stream).writeStream.format("memory").queryName("session_events").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.session_id, r.seq): (r.event, json.loads(r.data)) for r in spark.table("session_events").collect()}
    assert got[("s", 3)] == ("rejected", {"error": "Unknown prompt key: nope"}) and got[("s", 5)] == ("accepted", {"message_count": 1}) and got[("s", 4)][0] == "switched"


def test_commands(spark):
    lines = [" /EXIT", "/clear ", "/system buyer", "/system", "  ", "hello"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").select("i", sessions.command_of("line").alias("c")).orderBy("i").collect()
    assert [(r.c.cmd, r.c.arg) for r in got] == [("exit", None), ("clear", None), ("system", "buyer"), ("message", "/system"), ("ignore", None), ("message", "hello")]


def test_incremental_runs_only_what_is_new(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.range(3).write.parquet(src)
    run = lambda: incremental.run_available(spark, src, "id long", out, cp, lambda d: d.withColumn("x", d.id * 2))
    assert run() == 1 and run() == 0
    spark.range(3, 5).write.mode("append").parquet(src)
    run()
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8]


def test_adapters(spark, sf_dir):
    assert tables.qa_pairs(spark, sf_dir).count() == 34 and tables.qa_docs(spark, sf_dir).count() == 200
