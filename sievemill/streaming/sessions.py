"""Chat sessions as keyed state: the same step function folds a batch and a stream of commands.

Commands: message (user turn), completion (assistant turn of a finished answer), error (a failed answer: the
user turn stays), clear, system (switch of the prompt). A session exists from its first accepted command on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.config import Config

EVENT = schemas.SESSION_EVENT


def step(state: dict[str, Any] | None, cmd: str, arg: str | None, prompts: dict[str, str]) -> tuple[dict[str, Any] | None, str, dict[str, Any]]:
    """The next state, the event's kind and its data."""
    if cmd == "system" and arg not in prompts:
        return state, "rejected", {"error": f"Unknown prompt key: {arg}"}
    if cmd == "system":
        return _fresh(str(arg), prompts), "switched", {"prompt_key": arg}
    state = state or _fresh("default", prompts)
    if cmd == "clear":
        return _fresh(state["key"], prompts), "cleared", {"status": "cleared"}
    if cmd == "message":
        state["messages"].append(("user", arg or ""))
        return state, "accepted", {"message_count": len(state["messages"]) - 1}
    if cmd == "completion":
        state["messages"].append(("assistant", arg or ""))
        return state, "done", {"complete": True}
    if cmd == "error":
        return state, "error", {"error": arg}
    return state, "rejected", {"error": f"Unknown command: {cmd}"}


def _fresh(key: str, prompts: dict[str, str]) -> dict[str, Any]:
    return {"key": key, "messages": [("system", prompts.get(key, prompts["default"]))]}


def replay(commands: DataFrame, config: Config = Config()) -> DataFrame:
    """Last state of each session of a table of commands: key, number of turns, whether it exists; windows only.

    Only what follows the last clear or accepted switch is kept, and the key is that of the last accepted switch.
    """
    known = F.col("arg").isin(*config.system_prompts)
    order = Window.partitionBy("session_id").orderBy("seq")
    marked = commands.withColumns({"switch": (F.col("cmd") == "system") & F.coalesce(known, F.lit(False)), "turn": F.col("cmd").isin("message", "completion")})
    reset = F.sum(((F.col("cmd") == "clear") | F.col("switch")).cast("int")).over(order)
    seen = marked.withColumns({"part": reset, "accepted": F.col("switch") | F.col("cmd").isin("message", "completion", "clear", "error")})
    last = F.max("part").over(Window.partitionBy("session_id"))
    rows = seen.withColumn("last", last)
    return rows.groupBy("session_id").agg(
        F.coalesce(F.max_by(F.when(F.col("switch"), F.col("arg")), F.when(F.col("switch"), F.col("seq"))), F.lit("default")).alias("system_prompt_key"),
        F.count_if(F.col("turn") & (F.col("part") == F.col("last"))).alias("message_count"),
        F.max("accepted").alias("exists_"),
    )


class Counted:
    """The turns of a session, of which only the number is kept."""

    def __init__(self, n: int):
        self.n = n

    def append(self, turn: tuple[str, str]) -> None:
        self.n += 1

    def __len__(self) -> int:
        return self.n


def events(commands: DataFrame, config: Config = Config()) -> DataFrame:
    """One event a command of a stream (session_id, seq, cmd, arg), with state kept by session: its key and number of turns, whatever its length."""
    prompts = dict(config.system_prompts)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = {"key": state.get[0], "messages": Counted(state.get[1])} if state.exists else None
        out = []
        for r in pd.concat(list(parts)).sort_values("seq").itertuples(index=False):  # one key's rows of one trigger
            now, kind, data = step(now, r.cmd, r.arg, prompts)
            if now is not None and isinstance(now["messages"], list):
                now["messages"] = Counted(len(now["messages"]))
            out.append((key[0], r.seq, kind, json.dumps(data)))
        if now is not None:
            state.update((now["key"], len(now["messages"])))
        yield pd.DataFrame(out, columns=["session_id", "seq", "event", "data"])

    return commands.groupBy("session_id").applyInPandasWithState(run, EVENT, schemas.SESSION_STATE, "append", "NoTimeout")


def relay(fragments: DataFrame) -> DataFrame:
    """Events of answer fragments (session_id, seq, content, error): a message for each content, error or done at the end."""
    body = lambda name, c: F.to_json(F.struct(c.alias(name)))
    end = Window.partitionBy("session_id")
    rows = fragments.withColumn("last", F.max("seq").over(end))
    parts = rows.filter("content is not null and error is null").select("session_id", "seq", F.lit("message").alias("event"), body("content", F.col("content")).alias("data"))
    ends = rows.filter("seq = last").select("session_id", (F.col("seq") + 1).alias("seq"), F.when(F.col("error").isNotNull(), "error").otherwise("done").alias("event"), F.when(F.col("error").isNotNull(), body("error", F.col("error"))).otherwise(F.lit('{"complete":true}')).alias("data"))
    return parts.union(ends)


def command_of(line: str | Column) -> Column:
    """A typed line as (cmd, arg): ignored if empty, exit, clear, system with its key, else a message."""
    from sievemill.functions.text import strip

    t = strip(line)
    low = F.lower(t)
    cmd = F.when(t == "", "ignore").when(low.isin("/exit", "/quit"), "exit").when(low == "/clear", "clear").when(t.startswith("/system "), "system").otherwise("message")
    return F.struct(cmd.alias("cmd"), F.when(cmd == "system", F.regexp_replace(t, "^/system ", "")).when(cmd == "message", t).alias("arg"))


def typed(line: str) -> tuple[str, str | None]:
    """command_of for one line."""
    t = line.strip()
    if t.lower() in ("/exit", "/quit"):
        return "exit", None
    if t.lower() == "/clear":
        return "clear", None
    if t.startswith("/system "):
        return "system", t.split(" ", 1)[1]
    return ("message", t) if t else ("ignore", None)


def inspect(states: DataFrame, session_id: str) -> dict[str, Any]:
    """What is known of a session; looking does not make one."""
    row = states.filter(F.col("session_id") == session_id).filter("exists_").first()
    return {"exists": False} if row is None else {"exists": True, "system_prompt_key": row["system_prompt_key"], "message_count": row["message_count"]}


def listings(spark, config: Config = Config(), model_id: str | None = None) -> DataFrame:
    """The prompt keys in their order, with the model id (a fallback if none is known)."""
    return spark.createDataFrame([(i, k, model_id or config.service.model) for i, k in enumerate(config.system_prompts)], "ord int, prompt_key string, model_id string")
