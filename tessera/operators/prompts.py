"""Prompt building and batch inference with an injected model function.

Prompts are native string expressions. Inference is the one place a model
runs: ``mapInPandas`` over Arrow batches, the model built once per Python
worker through a factory, errors turned into NULL answers plus an error
column (never a failed job).
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_
from .partitioning import spread

# The text-to-SQL prompt parts.
DEFAULT_SCHEMA_LINES = (
    "CREATE TABLE Customers(customerID int, customerName text, city text);",
    "CREATE TABLE Orders(orderID int, customerID int, orderDate date, totalAmount decimal);",
    "CREATE TABLE Products(productID int, productName text, price decimal, category text);",
    "CREATE TABLE OrderDetails(orderID int, productID int, quantity int);",
)
SQL_INSTRUCTIONS = (
    "\n# Instructions",
    "Translate the following question into a valid SQL query based on the schema above.",
    "Return only the SQL query without any explanations.",
    "\n# Question",
)

# Fixed value: the sentiment prompt header (reviews are appended after it).
SENTIMENT_HEADER = (
    "Below are customer reviews. Please analyze the sentiment of each review "
    "and categorize it as Positive, Negative, or Neutral. Then, provide a summary in percentages: "
    "1. Total number of reviews "
    "2. Number of Positive reviews and their percentage (%) "
    "3. Number of Negative reviews and their percentage (%) "
    "4. Number of Neutral reviews and their percentage (%)\n\n"
    "Additionally, please provide the final metrics showing the percentage breakdown for each category "
    "in a clear and concise format.\n\n"
)

# Fixed value: the answer-refinement prompt; {q}, {tools} and {outputs} are
# filled per conversation.
REFINE_TEMPLATE = """
    You are an expert assistant that provides clear, concise, and well-structured answers.
    
    ORIGINAL QUESTION: {q}
    
    TOOLS USED:
    {tools}
    
    TOOL OUTPUTS: 
    {outputs}
    
    Please provide a final, refined answer to the original question based on the tool outputs. 
    Your answer should:
    1. Be direct and address the question completely
    2. Include relevant calculations or data from the tool outputs
    3. Be well-structured and easy to understand
    4. Provide any necessary context or explanation
    5. Be conversational in tone while remaining informative
    
    FINAL ANSWER:
    """


def sql_prompt(question, schema=None) -> Column:
    """Schema block (given, else the default four tables), instructions, question."""
    default = "\n".join(DEFAULT_SCHEMA_LINES)
    sch = F.lit(default) if schema is None else F.coalesce(F.nullif(col_(schema), F.lit("")), F.lit(default))
    return F.concat_ws("\n", F.lit("# Database Schema"), sch, *[F.lit(x) for x in SQL_INSTRUCTIONS], col_(question))


def refine_prompt(question, tools_json, outputs_json) -> Column:
    a, rest = REFINE_TEMPLATE.split("{q}")
    b, rest = rest.split("{tools}")
    c, d = rest.split("{outputs}")
    return F.concat(F.lit(a), col_(question), F.lit(b), col_(tools_json), F.lit(c), col_(outputs_json), F.lit(d))


def echo_model_factory() -> Callable[[str], str]:
    """Offline default model: answers with the prompt's last line as an SQL comment."""
    def model(prompt: str) -> str:
        return "-- " + prompt.rsplit("\n", 1)[-1]
    return lambda: model


def batch_infer(df: DataFrame, prompt_col: str, keep: list[str],
                model_factory: Callable[[], Callable[[str], str]] | None = None,
                answer_col: str = "answer") -> DataFrame:
    """Run the model on every prompt: answer stripped; NULL + error on failure."""
    factory = model_factory or echo_model_factory()
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"{answer_col} string", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in batches:
            answers, errors = [], []
            for p in pdf[prompt_col]:
                try:
                    answers.append(str(model(p)).strip())
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - per-row failure is data
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            out = pdf[keep].copy()
            out[answer_col] = answers
            out["error"] = errors
            yield out

    return spread(df.select(*keep, prompt_col)).mapInPandas(run, schema)


def image_messages(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """One user message per (path1, path2, question): text + two base64 images.

    ``images`` is (path, data) with base64 text; it is joined twice on path.
    """
    i1 = images.select(F.col("path").alias("path1"), F.col("data").alias("data1"))
    i2 = images.select(F.col("path").alias("path2"), F.col("data").alias("data2"))
    j = pairs.join(i1, "path1", "left").join(i2, "path2", "left")

    def img(c):
        return F.struct(F.lit("image").alias("type"), F.struct(
            F.lit("base64").alias("type"), F.lit("image/jpeg").alias("media_type"), F.col(c).alias("data")
        ).alias("source"))

    content = F.array(
        F.to_json(F.struct(F.lit("text").alias("type"), F.col("question").alias("text"))),
        F.to_json(img("data1")), F.to_json(img("data2")))
    msg = F.concat(F.lit('[{"role":"user","content":['), F.array_join(content, ","), F.lit("]}]"))
    return j.select("path1", "path2", "question", msg.alias("message"))
