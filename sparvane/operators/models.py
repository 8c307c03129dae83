"""Steps that ask a model: a plug-in takes a list of prompts and gives a list of answers, so any model fits.

Plug-ins run where the rows lie, a batch at a time, and must be importable by the workers. Nothing here
opens a connection or knows a model.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import search

#: Prompts in, answers out, in their order.
Model = Callable[[list[str]], list[str]]


def complete(prompt: Column, model: Model) -> Column:
    """The model's answer to each prompt; null prompts are not asked and give null."""

    def run(prompts: pa.Array) -> pa.Array:
        texts = prompts.to_pylist()
        asked = [k for k, t in enumerate(texts) if t is not None]
        answers = model([texts[k] for k in asked]) if asked else []
        if len(answers) != len(asked):
            raise ValueError("the model must give one answer per prompt")
        out = [None] * len(texts)
        for k, a in zip(asked, answers):
            out[k] = a
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(prompt)


def parse_answer(text: Column, schema: str) -> Column:
    """A struct out of an answer in JSON, mended if need be: fences and text around it, single quotes, commas before a closing bracket."""
    whole = F.from_json(text, schema)
    inner = F.regexp_extract(text, r"(?s)([\[{].*[\]}])", 1)
    mended = F.regexp_replace(F.regexp_replace(inner, r",\s*([\]}])", "$1"), r"'((?:[^'\\]|\\.)*)'(?=\s*[:,\]}])", '"$1"')
    return F.when(F.try_parse_json(text).isNotNull(), whole).when(F.try_parse_json(inner).isNotNull(), F.from_json(inner, schema)).otherwise(F.from_json(mended, schema))


def extract_fields(df: DataFrame, text: str, fields: dict[str, str], model: Model, name: str = "extracted") -> DataFrame:
    """``fields`` (name to SQL type) of each text, by a model that is asked for JSON."""
    ask = F.concat(F.lit(f"Give the fields {json.dumps(fields)} of the text below as one JSON object.\n"), F.col(text))
    schema = ", ".join(f"`{f}` {t}" for f, t in fields.items())
    return df.withColumn(name, parse_answer(complete(ask, model), schema))


def classify_by_model(df: DataFrame, text: str, labels: list[str], model: Model, name: str = "label") -> DataFrame:
    """The label that the model names (sentiment, topic and the like); null where its answer is none of them."""
    ask = F.concat(F.lit(f"Answer with one of {json.dumps(labels)}.\n"), F.col(text))
    answer = F.lower(F.trim(complete(ask, model)))
    return df.withColumn(name, F.coalesce(*[F.when(answer == label.lower(), label) for label in labels]))


def answer_questions(questions: DataFrame, documents: DataFrame, model: Model, k: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(question_id, question, sources, answer)``: each question with the ``k`` documents that share most of its words, put to the model.

    Words are matched by an equi-join of the questions' words with the documents'; rarer words weigh more.
    """
    asked = questions.select("question_id", F.explode(F.array_distinct(search.tokens(F.col("question")))).alias("term"))
    found = documents.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(search.tokens(F.col(text)))).alias("term"))
    found = found.join(asked.select("term").distinct(), "term", "left_semi")
    often = found.groupBy("term").agg((1.0 / F.log(2 + F.count("*"))).alias("weight"))
    scored = found.join(often, "term").join(asked, "term").groupBy("question_id", "_id").agg(F.sum("weight").alias("score"))
    best = Window.partitionBy("question_id").orderBy(F.desc("score"), "_id")
    near = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    texts = near.join(documents.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")).dropDuplicates(["_id"]), "_id")
    gathered = texts.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("_n", "_id", "_t"))).alias("_s"))  # at most k rows
    context = F.array_join(F.transform("_s", lambda x: x["_t"]), "\n\n")
    whole = questions.join(gathered, "question_id", "left")
    prompt = F.concat(F.coalesce(context, F.lit("")), F.lit("\n\nQuestion: "), F.col("question"))
    sources = F.coalesce(F.transform("_s", lambda x: x["_id"]), F.array().cast(f"array<{documents.schema[id_col].dataType.simpleString()}>"))
    return whole.select("question_id", "question", sources.alias("sources"), complete(prompt, model).alias("answer"))


def agent(goal: Column, model: Model, tools: dict[str, Callable[[str], str]], steps: int = 8) -> Column:
    """Lets the model call tools until it answers, at most ``steps`` times; null where it never does.

    It is given the goal and what the tools said so far, and answers ``{"tool": name, "input": text}`` or ``{"answer": text}``.
    All goals of a batch go on together, so the model is asked once per step.
    """
    listed = f"Tools: {', '.join(sorted(tools))}. Answer in JSON with tool and input, or with answer.\n"

    def run(goals: pa.Array) -> pa.Array:
        texts = goals.to_pylist()
        state = {k: listed + t for k, t in enumerate(texts) if t is not None}
        out: list[str | None] = [None] * len(texts)
        for _ in range(steps):
            if not state:
                break
            open_now = list(state)
            for k, said in zip(open_now, model([state[k] for k in open_now])):
                m = re.search(r"\{.*\}", said, re.S)
                try:
                    step = json.loads(m[0]) if m else {}
                except ValueError:
                    step = {}
                if "answer" in step:
                    out[k] = str(step["answer"])
                    del state[k]
                elif step.get("tool") in tools:
                    state[k] += f"\n{step['tool']}({step.get('input', '')}) = {tools[step['tool']](str(step.get('input', '')))}"
                else:
                    state[k] += "\nThat is no tool and no answer."
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(goal)
