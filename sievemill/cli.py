"""The pipeline's phases as commands: python -m sievemill.cli PHASE [--limit N] [--resume] [--sync] ...

Datasets lie below --data as Parquet (articles, questions, qa_pairs), JSON lines (training_data, final_training_data)
and JSON (metadata, quality_report, checkpoint). The model is a provider; offline the stub answers.
"""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill import config as settings
from sievemill.operators import aggregate, formatting, generate, joins, pages, sampling
from sievemill.plans import pipeline
from sievemill.session import ship
from sievemill.sources import files, http
from sievemill.streaming import sessions
from sievemill.streaming.incremental import Progress


class Run:
    def __init__(self, spark: SparkSession, args: argparse.Namespace, provider: generate.Provider | None = None, now=datetime.now, tuning: generate.TuningService | None = None):
        self.spark, self.args, self.now = ship(spark), args, now
        self.config = settings.load(args.config) if args.config else settings.Config()
        self.provider = provider or generate.StubProvider()
        self.tuning = tuning or generate.StubTuningService()

    def path(self, name: str) -> str:
        return os.path.join(self.args.data, name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def replace(self, df: DataFrame, name: str) -> int:
        """Writes a dataset beside the old one, then takes its place."""
        files.write_rows(df, self.path(name + ".new"))
        shutil.rmtree(self.path(name), ignore_errors=True)
        os.rename(self.path(name + ".new"), self.path(name))
        return self.read(name).count()

    def started(self, phase: str) -> tuple[Progress, DataFrame | None]:
        """The phase's progress, and the rows of an interrupted run if it is to be resumed."""
        progress = Progress(self.spark, self.path(f"{phase}.progress"))
        if not (self.args.resume and files.resumable(files.load_checkpoint(self.path("checkpoint.json")), phase)):
            progress.clear()
        return progress, progress.rows()

    def work_off(self, phase: str, progress: Progress, todo: DataFrame, stage: Callable[[DataFrame], DataFrame], every: int | None, old: int) -> None:
        """Runs a stage over what is to do, in batches, and keeps the checkpoint up to date."""
        total = old + todo.count()
        self.mark(phase, rows=old, total=total)

        def after(number: int) -> None:
            rows = progress.rows()
            self.mark(phase, rows=rows.count() if rows is not None else 0, total=total)

        progress.run(todo, stage, every, after)

    def finish(self, progress: Progress, name: str) -> int:
        """Makes the dataset of all runs, in their order, and forgets the progress."""
        rows = progress.rows()
        if rows is None:
            raise RuntimeError("no batch was written")
        ordered = rows.orderBy("run", "ord").drop("run", "ord").withColumn("ord", F.monotonically_increasing_id())
        n = self.replace(ordered, name)
        progress.clear()
        return n

    def mark(self, phase: str, **counters) -> None:
        files.save_checkpoint(self.path("checkpoint.json"), phase, self.now(), **counters)

    def scrape(self) -> int:
        """Home page to collections to article links to articles."""
        http.register(self.spark)
        s = self.config.scraping

        def fetched(urls: list[str]) -> DataFrame:
            options = {"urls": "\n".join(urls), "delay": s.request_delay_seconds, "timeout": s.timeout_seconds, "retries": s.max_retries, "agent": s.user_agent}
            return self.spark.read.format("pages").options(**options).load()

        home = fetched([s.base_url])
        collections = pages.collections(home, s).orderBy("ord").collect()  # one row a collection
        listed = fetched([c.url for c in collections])
        about = self.spark.createDataFrame([(c.url, c.name, c.id) for c in collections], "url string, collection string, collection_id string")
        refs = sampling.head(pages.article_refs(listed.filter("html is not null").join(about, "url"), s), self.args.limit)
        progress, old = self.started("scraping")
        todo = refs if old is None else refs.join(old.select(F.col("article_id").alias("id")), "id", "left_anti")

        def read(batch: DataFrame) -> DataFrame:
            batch = batch.withColumn("at", F.col("ord"))
            page = fetched([r.url for r in batch.select("url").collect()])  # one batch's; the reader paces requests by host
            got = pages.articles(batch.drop("ord").join(page, "url"), s).filter("error is null").drop("error", "ord")
            return got.join(batch.select(F.col("id").alias("article_id"), F.col("at").alias("ord")), "article_id")

        before = 0 if old is None else old.count()
        todo = todo.persist()
        asked = todo.count()
        self.work_off("scraping", progress, todo, read, self.args.every or 10, before)
        todo.unpersist()
        n = self.finish(progress, "articles")
        self.mark("scraping_complete", articles=n)
        print(f"SCRAPING COMPLETE\nCollections: {len(collections)}\nArticles: {n}\nFailed: {before + asked - n}")
        self.breakdown(self.read("articles"), "collection")
        return 0

    def flat_articles(self) -> DataFrame:
        return self.read("articles").select("article_id", "title", "collection", "description", F.col("content.markdown").alias("markdown"), "ord")

    def questions(self) -> int:
        flat = sampling.head(self.flat_articles(), self.args.limit)
        progress, old = self.started("questions")
        todo = flat if old is None else joins.not_done(flat, old, "article_id")
        if todo.isEmpty() and old is None:
            print("All articles already processed")
            return 0
        g = self.config.generation

        def directly(batch: DataFrame) -> DataFrame:
            return generate.generate_questions(batch, self.provider, self.config)

        def in_a_batch(batch: DataFrame) -> DataFrame:
            lines = generate.requests(batch, "article_id", generate.question_prompt(self.config), self.config, g.temperature_questions, g.max_tokens_questions)
            results = generate.run_batch(lines, self.path("questions_batch"), generate.StubBatchService(self.args.data, self.provider), settings=self.config.service)
            answered = results.filter("error is null").select(F.col("custom_id").alias("article_id"), F.col("content").alias("response"), "ord")
            return joins.with_article(generate.questions_from(answered, batch=True), flat).select("article_id", "title", "collection", "questions", "ord")

        if todo.isEmpty():
            print("All articles already processed")
        else:
            self.work_off("questions", progress, todo, directly if self.args.sync else in_a_batch, (self.args.every or 5) if self.args.sync else None, 0 if old is None else old.count())
        n = self.finish(progress, "questions")
        total = self.read("questions").agg(F.sum(F.size("questions"))).first()[0] or 0
        self.mark("questions_complete", articles_processed=n)
        print(f"QUESTION GENERATION COMPLETE\nArticles processed: {n}\nTotal questions: {total}\nAverage questions per article: {total / n if n else 0:.1f}")
        return 0

    def answers(self) -> int:
        flat = self.flat_articles()
        items = sampling.head(joins.work_items(self.read("questions"), flat), self.args.limit)
        progress, old = self.started("answers")
        todo = items if old is None else joins.not_done(items, old, "qa_id")
        if todo.isEmpty() and old is None:
            print("All Q&A pairs already processed")
            return 0
        g = self.config.generation

        def directly(batch: DataFrame) -> DataFrame:
            return generate.generate_answers(batch, self.provider, self.config)

        def in_a_batch(batch: DataFrame) -> DataFrame:
            lines = generate.requests(batch, "qa_id", generate.answer_prompt(self.config), self.config, g.temperature_answers, g.max_tokens_answers)
            results = generate.run_batch(lines, self.path("answers_batch"), generate.StubBatchService(self.args.data, self.provider), settings=self.config.service)
            return generate.answers_from_batch(results.drop("ord"), batch)

        if todo.isEmpty():
            print("All Q&A pairs already processed")
        else:
            self.work_off("answers", progress, todo, directly if self.args.sync else in_a_batch, (self.args.every or 10) if self.args.sync else None, 0 if old is None else old.count())
        n = self.finish(progress, "qa_pairs")
        self.mark("answers_complete", qa_pairs_generated=n)
        print(f"ANSWER GENERATION COMPLETE\nQ&A pairs generated: {n}")
        self.breakdown(self.read("qa_pairs"), "question_type")
        return 0

    def format(self) -> int:
        pairs = self.read("qa_pairs")
        files.write_lines(formatting.example_lines(pairs, self.config), self.path("training_data.jsonl"))
        described = pipeline.metadata(pairs, self.path("training_data.jsonl"), self.now())
        files.write_json(self.path("metadata.json"), described)
        print(f"FORMATTING COMPLETE\nTotal examples: {described['total_examples']}\nSource articles: {described['source_articles']}\nAvg questions per article: {described['avg_questions_per_article']:.1f}\nAvg answer length: {described['avg_answer_length_chars']:.0f} chars")
        for c in described["collections_covered"][:5]:
            print(f"  - {c['name']}: {c['examples']}")
        return 0

    def check(self) -> int:
        pairs = self.read("qa_pairs")
        texts = self.read("articles").select("article_id", F.col("content.plain_text").alias("plain_text"), "ord")
        out = pipeline.validate_set(pairs, texts, files.read_lines(self.spark, self.path("training_data.jsonl")), self.now(), self.config, self.args.seed)
        files.write_lines(formatting.example_lines(out.pairs, self.config), self.path("final_training_data.jsonl"))
        passed = out.report.pop("validation_passed")
        files.write_json(self.path("quality_report.json"), out.report)
        if os.path.exists(self.path("metadata.json")):
            described = files.load_checkpoint(self.path("metadata.json"))
            files.write_json(self.path("metadata.json"), described | {"validation_passed": passed, "final_examples": out.report["examples_after_validation"]})
        r, auto = out.report, out.report["automated_checks"]
        total, sample = r["total_examples_generated"], r["semantic_checks_sample"]
        print(f"QUALITY ASSURANCE COMPLETE\nOriginal examples: {total}\nAfter validation: {r['examples_after_validation']}\nRemoved: {total - r['examples_after_validation']}")
        print(f"  - JSON validity: {auto['json_validity']['passed']}/{total}\n  - Content length: {auto['content_length']['passed']}/{total}\n  - Grounding rate: {sample['grounding_pass_rate']:.1%} of {sample['sample_size']}")
        print(f"  - Exact duplicates removed: {r['removal_reasons']['duplicate_exact']}\n  - Near duplicates removed: {r['removal_reasons']['duplicate_near']}")
        for text in r["recommendations"]:
            print(f"  - {text}")
        return 0

    def finetune(self) -> int:
        """Readiness, upload, the file's check, and the job; a dry run stops before the service is asked."""
        path = self.path("final_training_data.jsonl")
        if not generate.finetune_ready(path):
            print("Training file not found", file=sys.stderr)
            return 1
        if self.args.dry_run:
            print(f"[DRY RUN] {json.dumps(generate.finetune_request(self.config.finetuning, 'file-dummy-id'))}")
            return 0
        file_id = self.tuning.upload(path)
        if not generate.wait_for_file(lambda: self.tuning.file_status(file_id)):
            print("File processing failed", file=sys.stderr)
            return 1
        request = generate.finetune_request(self.config.finetuning, file_id)
        job = self.tuning.create(request)
        files.write_json(self.path("finetune_job.json"), {"job_id": job, "request": request, "created_at": self.now().isoformat()})
        status = generate.wait_for_job(lambda: self.tuning.job_status(job))
        print(f"Fine-tuning {status}: {job}")
        return 0 if status == "succeeded" else 1

    def chat(self, lines=None) -> int:
        """A session on the terminal: /exit, /quit, /clear, /system KEY."""
        prompts = self.config.system_prompts
        state, _, _ = sessions.step(None, "system", self.args.system if self.args.system in prompts else "default", prompts)
        for line in lines if lines is not None else sys.stdin:
            cmd, arg = sessions.typed(line)
            if cmd == "exit":
                break
            if cmd == "ignore":
                continue
            state, event, data = sessions.step(state, cmd, arg, prompts)
            if cmd != "message":
                print(data.get("error") or ("Conversation history cleared." if event == "cleared" else f"Switched to system prompt: {arg}"))
                continue
            asked = "\n".join(f"{role}: {content}" for role, content in state["messages"])
            answer = generate.complete(self.provider, asked, service=self.config.service)
            print(f"Assistant: {answer}" if answer is not None else "Error: no answer")
            state, _, _ = sessions.step(state, *(("completion", answer) if answer is not None else ("error", "no answer")), prompts)
        return 0

    def breakdown(self, df: DataFrame, column: str) -> None:
        for r in aggregate.by_count(aggregate.counts(df, F.coalesce(F.col(column), F.lit("unknown")))).collect():
            print(f"  - {r['name']}: {r['examples']}")


PHASES = ["scrape", "questions", "answers", "format", "check", "finetune", "chat"]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sievemill", description=__doc__)
    p.add_argument("phase", choices=PHASES)
    p.add_argument("--data", default="data")
    p.add_argument("--config", help="YAML settings")
    p.add_argument("--limit", type=int, help="articles, or question/answer pairs in the answers phase")
    p.add_argument("--resume", action="store_true", help="go on with an interrupted phase")
    p.add_argument("--every", type=int, help="items after which progress is kept (10, 5 in the questions phase)")
    p.add_argument("--sync", action="store_true", help="one completion at a time instead of a batch")
    p.add_argument("--dry-run", action="store_true", help="validate files only (finetune)")
    p.add_argument("--system", default="default", help="system prompt key (chat)")
    p.add_argument("--seed", default="1", help="of the grounding sample (check)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"sievemill {args.phase}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return getattr(Run(spark, args), args.phase)()


if __name__ == "__main__":
    sys.exit(main())
