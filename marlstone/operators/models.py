"""The seam for language models: a provider answers prompts; everything around it is rows.

A provider is made on each worker by a function that is sent there, so that keys and connections never leave it.
Answers are kept in a table by the hash of the prompt; only prompts that it lacks are asked.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import strip, sub, text_of
from ..functions.predicates import answer_quality, question_fault
from ..functions.text import first_filled, json_payload, light_clean


class Provider(Protocol):
    def answer(self, prompt: str, system: str) -> str | None:
        """None if it failed."""


class Echo:
    """A provider for tests: the same answer for the same prompt, without a network."""

    def __init__(self, prefix: str = ""):
        self.prefix = prefix

    def answer(self, prompt: str, system: str) -> str | None:
        return self.prefix + prompt


def share_of(quota: int, workers: int) -> int:
    """What one of so many workers may use of a quota for all of them, so that together they keep it."""
    if quota < workers:
        raise ValueError(f"a quota of {quota} cannot be shared by {workers} workers: use fewer")
    return quota // workers


class Limited:
    """Keys in turn, each with so many requests and tokens in any 60 seconds, parked for a while after a refusal.
    The quota is that of the key; ask() runs workers tasks at a time, each with its share (workers), so that a key's
    quota holds over all of them. now and sleep are the clock's."""

    def __init__(self, providers: list[Provider], requests: int = 12, tokens: int = 240_000, park: float = 60.0, tries: int = 4, workers: int = 1, now=time.monotonic, sleep=time.sleep):
        self.keys = [(p, deque()) for p in providers]
        self.requests, self.tokens, self.park, self.tries, self.now, self.sleep = share_of(requests, workers), share_of(tokens, workers), park, tries, now, sleep
        self.parked = [0.0] * len(providers)

    def _free(self, cost: int) -> int | None:
        t = self.now()
        for i, (_, used) in enumerate(self.keys):
            while used and used[0][0] <= t - 60:
                used.popleft()
            if self.parked[i] <= t and len(used) < self.requests and (not used or sum(c for _, c in used) + cost <= self.tokens):
                return i
        return None

    def answer(self, prompt: str, system: str) -> str | None:
        cost = (len(prompt) + len(system)) // 3
        for _ in range(self.tries):
            while (i := self._free(cost)) is None:
                self.sleep(0.5)
            provider, used = self.keys[i]
            used.append((self.now(), cost))
            if (got := provider.answer(prompt, system)) is not None:
                return got
            self.parked[i] = self.now() + self.park
        return None


def prompt_key(prompt: Column, system: Column) -> Column:
    return F.sha1(F.concat(system, F.lit("\n"), prompt))


def ask(df: DataFrame, prompt: Column, make_provider: Callable[[], Provider], system: str = "", cache: DataFrame | None = None, workers: int | None = None) -> DataFrame:
    """df with key and answer (null if it failed). cache: key, answer of earlier runs. Each prompt is asked once;
    workers bounds how many tasks ask at a time."""
    rows = df.withColumn("key", prompt_key(prompt, F.lit(system))).withColumn("prompt", prompt)
    asked = rows.select("key", "prompt").dropDuplicates(["key"])
    if cache is not None:
        asked = asked.join(cache.select("key"), "key", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider = make_provider()
        for batch in batches:
            answers = [provider.answer(p, system) for p in batch["prompt"].to_pylist()]
            yield pa.record_batch([batch["key"], pa.array(answers, pa.string())], names=["key", "answer"])

    asked = asked.repartition(workers) if workers else asked
    answers = asked.mapInArrow(run, "key string, answer string")
    if cache is not None:
        answers = answers.unionByName(cache.select("key", "answer"))
    return rows.join(answers, "key", "left").drop("prompt")


def cleaned_chunk(answer: Column) -> Column:
    """struct<status, text, quality> of a cleaning answer: skip, low_quality (under 0.4) or ok; err for null."""
    raw = strip(text_of(answer))
    text = strip(sub(raw, "(?i)<\\s*SKIP\\s*>"))
    q = answer_quality(text)
    row = lambda status, t, v: F.struct(F.lit(status).alias("status"), t.alias("text"), v.alias("quality"))
    none = F.lit("")
    return F.when(answer.isNull(), row("err", none, F.lit(0.0))).when((raw == "") | raw.rlike("(?i)\\A\\s*<\\s*SKIP\\s*>\\s*\\z"), row("skip", none, F.lit(0.0))).when(q < 0.4, row("low_quality", text, q)).otherwise(row("ok", text, q))


def reassemble(chunks: DataFrame, book: str, idx: str, original: str, answer: str, on_error: str = "keep") -> DataFrame:
    """A text per book from its chunks' answers in order. Failed chunks: keep the original, clean it lightly
    (light), or fail the whole book (fail: its text is null). Empty answers drop their chunk."""
    a = F.col(answer)
    instead = {"keep": F.col(original), "light": light_clean(F.col(original)), "fail": F.lit(None).cast("string")}[on_error]
    t = F.when(a.isNull(), instead).otherwise(a)
    rows = chunks.groupBy(book).agg(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), t.alias("t")))).alias("c"))
    failed = F.exists("c", lambda x: x["t"].isNull())
    text = F.array_join(F.filter(F.transform("c", lambda x: x["t"]), lambda x: x != ""), "\n\n")
    return rows.select(book, F.when(~failed, text).alias("text"), F.size("c").alias("chunks"))


def batched_prompts(df: DataFrame, order: str, item: Column, head: str, size: int = 20, slices: int | None = None) -> DataFrame:
    """Prompts of up to size items each, as a JSON list behind head: batch, prompt, members (ids in order). Items
    are batched within slices of the hash of their id, of some thousand batches each, so that no task numbers them
    all."""
    slices = slices or max(1, -(-df.count() // (1000 * size)))
    rows = df.select(F.col(order).alias("o"), item.alias("item")).withColumn("slice", F.pmod(F.xxhash64("o"), F.lit(slices)))
    n = F.row_number().over(Window.partitionBy("slice").orderBy("o")) - 1
    rows = rows.withColumn("batch", F.concat_ws(":", "slice", F.floor(n / size)))
    g = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("o", "item"))).alias("m"))
    return g.select("batch", F.concat(F.lit(head), F.lit("\n\n"), F.to_json(F.transform("m", lambda x: x["item"]))).alias("prompt"), F.transform("m", lambda x: x["o"]).alias("members"))


def cleaned_turns(answers: DataFrame) -> DataFrame:
    """id, text of answered batches (members, turns, answer): the answer is a JSON list of {i, text}; a turn whose i
    is missing, out of range or given an empty text keeps its own, of several texts for one i the last counts."""
    list_ = F.regexp_extract(text_of(F.col("answer")), "(?s)(\\[.*\\])", 1)
    given = F.coalesce(F.from_json(list_, "array<struct<i:int,text:string>>"), F.array().cast("array<struct<i:int,text:string>>"))
    rows = answers.withColumn("given", given).select("turns", "given", F.posexplode("members").alias("i", "id"))
    mine = F.filter("given", lambda g: (g["i"] == F.col("i")) & (strip(text_of(g["text"])) != ""))
    last = F.when(F.size(mine) > 0, strip(F.element_at(mine, -1)["text"]))
    return rows.select("id", F.coalesce(last, F.get("turns", F.col("i"))).alias("text"))


def tagged(answers: DataFrame, topics: list[str], default: str = "Dentistry") -> DataFrame:
    """id, topic of answered batches (members, answer): topics not listed, missing or unreadable are the default."""
    list_ = F.regexp_extract(text_of(F.col("answer")), "(?s)(\\[.*\\])", 1)
    names = F.coalesce(F.from_json(list_, "array<string>"), F.array().cast("array<string>"))
    topic = F.coalesce(strip(F.get(names, F.col("i"))), F.lit(default))
    rows = answers.withColumn("names", names).select("names", F.posexplode("members").alias("i", "id"))
    topic = F.coalesce(strip(F.get(F.col("names"), F.col("i"))), F.lit(default))
    return rows.select("id", F.when(topic.isin(topics), topic).otherwise(F.lit(default)).alias("topic"))


ITEM = "question string, chosen string, rejected string, topic string"


def generated_items(answers: DataFrame, keys: list[str], answer_col: str, source_col: str, topics: list[str]) -> DataFrame:
    """The items of each answer (a JSON object with items, or a list), by position: keys, item_idx, question,
    chosen, rejected, topic, verdict. Refused items keep their reason."""
    a = text_of(F.col(answer_col))
    listed = F.from_json(F.regexp_extract(a, "(?s)(\\[.*\\])", 1), f"array<struct<{', '.join(x.replace(' ', ':') for x in ITEM.split(', '))}>>")
    inner = F.from_json(F.get_json_object(json_payload(a), "$.items"), f"array<struct<{', '.join(x.replace(' ', ':') for x in ITEM.split(', '))}>>")
    rows = answers.select(*keys, F.col(source_col).alias("_source"), F.posexplode(F.coalesce(inner, listed)).alias("item_idx", "i"))
    topic = first_filled(F.col("i.topic"), F.lit("Dentistry"))
    return rows.select(
        *keys, "item_idx", *[strip(text_of(F.col(f"i.{c}"))).alias(c) for c in ("question", "chosen", "rejected")], F.when(topic.isin(topics), topic).otherwise(F.lit("Dentistry")).alias("topic"),
        question_fault(F.col("i.question"), F.col("i.chosen"), F.col("i.rejected"), F.col("_source")).alias("verdict"),
    )


def usage_in_window(df: DataFrame, key: str, seconds: str, tokens: str, width: int = 60) -> DataFrame:
    """df with requests and tokens_used of the key in the last so many seconds, this request's among them."""
    w = Window.partitionBy(key).orderBy(seconds).rangeBetween(-width, 0)
    return df.withColumns({"requests": F.count("*").over(w), "tokens_used": F.sum(tokens).over(w)})


def to_json_report(counts: dict) -> str:
    return json.dumps(counts, ensure_ascii=False, sort_keys=True)
