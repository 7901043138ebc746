import http.server
import json
import os
import threading

import pytest

from sievemill import cli
from sievemill.operators import generate

SITE = {
    "/en/": '<a href="/collections/1-first-steps?x">A</a><a href="/collections/2-b">B</a>',
    "/collections/1-first-steps": '<a href="/articles/10-a">Ten</a><a href="/articles/11-b?q">Eleven</a>',
    "/collections/2-b": '<a href="/articles/10-a">Ten again</a><a href="/articles/12-gone">Gone</a>',
    "/articles/10-a": "<article><h1>Ten</h1><p>The fee is 10 dollars, paid once a year.</p></article>",
    "/articles/11-b": "<article><h1>Eleven</h1><p>Nothing costs more than 11 dollars here.</p></article>",
}


@pytest.fixture
def site():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            body = SITE.get(self.path)
            self.send_response(200 if body else 404)
            self.end_headers()
            self.wfile.write((body or "").encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_phases_from_site_to_training_set(spark, tmp_path, site, capsys):
    (tmp_path / "c.yaml").write_text(json.dumps({"scraping": {"base_url": f"{site}/en/", "request_delay_seconds": 0, "max_retries": 1}, "service": {"batch_check_interval_seconds": 0}, "validation": {"semantic_sample_rate": 1.0}}))
    data = str(tmp_path / "data")

    def run(*argv):
        args = cli.arguments([*argv, "--data", data, "--config", str(tmp_path / "c.yaml")])
        return getattr(cli.Run(spark, args), args.phase)()

    assert run("finetune", "--dry-run") == 1
    assert run("scrape") == 0
    got = {(r.article_id, r.title, r.collection) for r in spark.read.parquet(f"{data}/articles").collect()}
    assert got == {("10", "Ten", "First Steps"), ("11", "Eleven", "First Steps")}
    assert run("questions") == 0 and run("answers", "--limit", "5", "--sync") == 0
    assert spark.read.parquet(f"{data}/qa_pairs").count() == 5
    assert run("answers") == 0 and spark.read.parquet(f"{data}/qa_pairs").count() == 8
    assert json.load(open(f"{data}/checkpoint.json"))["phase"] == "answers_complete"
    assert run("questions", "--resume") == 0 and not os.path.exists(f"{data}/questions.progress")  # a completed phase starts anew
    assert run("format") == 0 and run("check") == 0 and run("finetune", "--dry-run") == 0 and run("finetune") == 0
    assert "[DRY RUN]" in capsys.readouterr().out and json.load(open(f"{data}/finetune_job.json"))["job_id"].startswith("job-")
    report, meta = (json.load(open(f"{data}/{f}.json")) for f in ("quality_report", "metadata"))
    assert report["total_examples_generated"] == 8 == meta["total_examples"] and meta["final_examples"] == report["examples_after_validation"]
    assert report["automated_checks"]["json_validity"] == {"passed": 8, "failed": 0}
    final = [f for f in os.listdir(f"{data}/final_training_data.jsonl") if f.startswith("part-")]
    assert sum(len(open(f"{data}/final_training_data.jsonl/{f}").readlines()) for f in final) == report["examples_after_validation"]


def test_chat(spark, tmp_path, capsys):
    class Echo:
        def complete(self, prompt, temperature, max_tokens):
            return f"{len(prompt.splitlines())} lines"

    run = cli.Run(spark, cli.arguments(["chat", "--data", str(tmp_path)]), provider=Echo())
    run.chat(["hi\n", "\n", "again", "/system nope", "/system buyer", "/clear", "x", "/QUIT", "unread"])
    assert capsys.readouterr().out.split("\n")[:-1] == ["Assistant: 2 lines", "Assistant: 4 lines", "Unknown prompt key: nope", "Switched to system prompt: buyer", "Conversation history cleared.", "Assistant: 2 lines"]
    assert isinstance(generate.StubProvider().complete("p", 0, 1), str)


class Noting:
    """Notes every prompt in a file, as providers run in workers."""

    def __init__(self, path):
        self.path, self.inner = path, generate.StubProvider()

    def complete(self, prompt, temperature, max_tokens):
        with open(self.path, "a") as f:
            print(prompt.replace("\n", " "), file=f)
        return self.inner.complete(prompt, temperature, max_tokens)


class Killed(Exception):
    pass


def killed_after(monkeypatch, batches):
    """The process dies once so many batches of a phase are written."""
    marks = []
    kept = cli.Run.mark

    def mark(self, phase, **counters):
        kept(self, phase, **counters)
        marks.append(phase)
        if marks.count(phase) > batches and not phase.endswith("complete"):
            raise Killed

    monkeypatch.setattr(cli.Run, "mark", mark)


def articles(spark, path, n):
    content = "named_struct('raw_html', '', 'markdown', concat('The fee of ', id, ' is ', id * 10, ' dollars, to be paid once a year.'), 'plain_text', '', 'sections', array())"
    spark.range(n).selectExpr("cast(id as string) article_id", "concat('Title ', id) title", "'Help' collection", "'' description", f"{content} content", "id ord").write.parquet(path)


@pytest.mark.parametrize("phase,every,killed,done,total", [("questions", 2, 3, 6, 11), ("answers", 10, 2, 20, 44)])
def test_a_killed_phase_goes_on_with_the_rest(spark, tmp_path, monkeypatch, capsys, phase, every, killed, done, total):
    data = str(tmp_path)
    articles(spark, f"{data}/articles", 11)

    def run(phase, *argv, note="other"):
        args = cli.arguments([phase, "--data", data, "--sync", *argv])
        return getattr(cli.Run(spark, args, Noting(f"{data}/{note}")), phase)()

    name = {"questions": "questions", "answers": "qa_pairs"}[phase]
    if phase == "answers":
        run("questions")
    with monkeypatch.context() as m:
        killed_after(m, killed)
        with pytest.raises(Exception, match="Killed"):
            run(phase, "--every", str(every), note="first")
    state = json.load(open(f"{data}/checkpoint.json"))
    assert state["phase"] == phase and state["rows"] == done and state["total"] == total and not os.path.exists(f"{data}/{name}")
    assert run(phase, "--resume", note="second") == 0
    first, second = (open(f"{data}/{f}").read().splitlines() for f in ("first", "second"))
    assert len(first) == done and len(second) == total - done and not set(first) & set(second)
    got = spark.read.parquet(f"{data}/{name}").orderBy("ord").collect()
    key = "article_id" if phase == "questions" else "qa_id"
    assert len({r[key] for r in got}) == len(got) == total
    if phase == "questions":
        assert [r.article_id for r in got] == [str(i) for i in range(11)]
    assert json.load(open(f"{data}/checkpoint.json"))["phase"] == f"{phase}_complete" and not os.path.exists(f"{data}/{phase}.progress")
    # without --resume an interrupted phase starts anew
    with monkeypatch.context() as m:
        killed_after(m, 1)
        with pytest.raises(Exception, match="Killed"):
            run(phase, "--every", str(every))
    run(phase, note="third")
    assert len(open(f"{data}/third").read().splitlines()) == total


def test_a_killed_scrape_goes_on_with_the_rest(spark, tmp_path, site, monkeypatch, capsys):
    (tmp_path / "c.yaml").write_text(json.dumps({"scraping": {"base_url": f"{site}/en/", "request_delay_seconds": 0, "max_retries": 1}}))

    def run(*argv):
        return cli.Run(spark, cli.arguments(["scrape", "--data", str(tmp_path), "--config", str(tmp_path / "c.yaml"), *argv])).scrape()

    with monkeypatch.context() as m:
        killed_after(m, 1)
        with pytest.raises(Exception, match="Killed"):
            run("--every", "1")
    assert json.load(open(tmp_path / "checkpoint.json")) | {"last_updated": ""} == {"phase": "scraping", "last_updated": "", "rows": 1, "total": 3}
    monkeypatch.setitem(SITE, "/articles/10-a", "<article><h1>Changed</h1><p>Not read again.</p></article>")
    assert run("--resume") == 0 and "Articles: 2\nFailed: 1" in capsys.readouterr().out
    assert [(r.article_id, r.title) for r in spark.read.parquet(str(tmp_path / "articles")).orderBy("ord").collect()] == [("10", "Ten"), ("11", "Eleven")]


def test_finetune_waits_for_the_file(spark, tmp_path, capsys):
    class Tuning(generate.StubTuningService):
        def __init__(self, *statuses):
            self.statuses = list(statuses)

        def file_status(self, file_id):
            return self.statuses.pop(0)

    (tmp_path / "final_training_data.jsonl").write_text("{}\n")
    run = lambda t: cli.Run(spark, cli.arguments(["finetune", "--data", str(tmp_path)]), tuning=t).finetune()
    assert run(Tuning("error")) == 1 and not (tmp_path / "finetune_job.json").exists()
    assert run(Tuning("processed")) == 0 and (tmp_path / "finetune_job.json").exists()
    waits = []
    assert generate.wait_for_file(iter(["uploaded", "running", "processed"]).__next__, 2.0, waits.append) and waits == [2.0, 2.0]
