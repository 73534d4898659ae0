"""From ranked passages to prompts, and from answers to scores: all but the model itself, which is any function of a prompt."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.retrieval import answer_pattern

#: What an answer says that finds nothing in its passages.
ABSTAINS = "nothing here answers this"


def prompts(questions: DataFrame, ranking: DataFrame, passages: DataFrame, most: int = 5) -> DataFrame:
    """query_id, prompt, excerpts (ids in order): a question's (query_id, text, as_of) first passages (doc_id, context, text), numbered from 1."""
    top = ranking.where(F.col("rank") <= most).select("query_id", "rank", "doc_id").join(passages.select("doc_id", "context", F.col("text").alias("said")), "doc_id")
    listed = top.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id", "context", "said"))).alias("top"))
    told = questions.select("query_id", "text", "as_of").join(listed, "query_id", "left").withColumn("top", F.coalesce("top", F.array().cast(dict(listed.dtypes)["top"])))
    lines = F.transform("top", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x["context"], F.lit("\n"), x["said"]))
    body = F.when(F.size("top") == 0, "(none)").otherwise(F.array_join(lines, "\n\n"))
    prompt = F.concat(F.lit("Known on "), F.date_format("as_of", "yyyy-MM-dd HH:mm"), F.lit(" (UTC), from these passages alone:\n\n"), body, F.lit("\n\nQuestion: "), F.col("text"))
    return told.select("query_id", prompt.alias("prompt"), F.transform("top", lambda x: x["doc_id"]).alias("excerpts"))


def ask(asked: DataFrame, model: Callable[[list[str]], list[str]]) -> DataFrame:
    """query_id, answer: ``model`` answers batches of prompts where they lie."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model(batch.column(1).to_pylist()), pa.string())], names=["query_id", "answer"])

    kind = dict(asked.dtypes)["query_id"]
    return asked.select("query_id", "prompt").mapInArrow(run, f"query_id {kind}, answer string")


def citations(answer: Column, excerpts: Column) -> Column:
    """The numbers in brackets that name an excerpt, ascending."""
    found = F.transform(F.regexp_extract_all(answer, F.lit(r"\[(\d{1,6})\]"), F.lit(1)), lambda x: x.cast("int"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda n: (n >= 1) & (n <= F.size(excerpts)))))


def judged(answers: DataFrame, asked: DataFrame, truth: DataFrame) -> DataFrame:
    """Per question: answerable (a relevant excerpt was shown), states_value, cites_relevant, abstains.

    ``asked``: query_id, excerpts; ``truth``: query_id, answers (how the value may be printed), relevant (ids).
    """
    df = asked.select("query_id", "excerpts").join(answers, "query_id", "left").join(truth, "query_id").withColumn("answer", F.coalesce("answer", F.lit("")))
    cited = F.transform(citations(F.col("answer"), F.col("excerpts")), lambda n: F.get(F.col("excerpts"), n - 1))
    return df.select(
        "query_id",
        F.arrays_overlap("excerpts", "relevant").alias("answerable"),
        ((F.size("answers") > 0) & F.regexp_like("answer", answer_pattern(F.col("answers")))).alias("states_value"),
        (F.size(F.array_intersect(cited, F.col("relevant"))) > 0).alias("cites_relevant"),
        F.lower("answer").contains(ABSTAINS).alias("abstains"),
    )


def scores(judged_answers: DataFrame) -> DataFrame:
    """One row: shares of right answers (the value where there is one to find, else an abstention), and what they are made of."""
    share = lambda c: F.avg(c.cast("double"))
    right = F.when(F.col("answerable"), F.col("states_value")).otherwise(F.col("abstains"))
    return judged_answers.agg(
        F.count("*").alias("questions"), share(right).alias("correct"), share(F.col("states_value")).alias("accuracy"), share(F.col("cites_relevant")).alias("cited_relevant"),
        F.coalesce(share(F.when(~F.col("answerable"), F.col("abstains"))), F.lit(1.0)).alias("abstained_when_unanswerable"),
        F.coalesce(share(F.when(F.col("answerable"), F.col("abstains"))), F.lit(0.0)).alias("abstained_when_answerable"), share(F.col("answerable")).alias("answerable"),
    )


def training_groups(candidates: DataFrame, size: int = 8, seed: str = "") -> DataFrame:
    """For a reranker: per question one relevant candidate and up to size - 1 others, chosen by hash; questions without both are left out.

    ``candidates``: query_id, doc_id, relevant.
    """
    from pyspark.sql import Window

    key = F.sha2(F.concat_ws("|", F.lit(seed), F.col("query_id").cast("string"), F.col("doc_id").cast("string")), 256)
    place = F.row_number().over(Window.partitionBy("query_id", "relevant").orderBy(key, "doc_id"))
    kept = candidates.withColumn("n", place).where((F.col("relevant") & (F.col("n") == 1)) | (~F.col("relevant") & (F.col("n") < size)))
    both = kept.groupBy("query_id").agg(F.count_if("relevant").alias("r"), F.count_if(~F.col("relevant")).alias("w")).where("r = 1 and w > 0").select("query_id")
    return kept.join(both, "query_id", "left_semi").select("query_id", "doc_id", "relevant")


def withheld_variant(query_id: Column, every: int = 10) -> Column:
    """Whether a question also gets a variant without its relevant passages, so that a model learns to abstain."""
    return F.conv(F.substring(F.sha2(query_id.cast("string"), 256), 1, 8), 16, 10).cast("long") % every == 0
