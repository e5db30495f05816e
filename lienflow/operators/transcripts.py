"""Answers in call transcripts.

A line answers a question when it contains at least half of the question's telling words; the
answer is what the next four lines say.  Questions are a short parameter list, so each of them
becomes an expression and nothing is joined with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lienflow import fixed_values as fixed
from lienflow.functions.sql import quote
from lienflow.functions.text import clean, question_key

ANSWER_LINES = 4
HUMAN_CHARS = 50


def _is_asked(line: str, question: str) -> str:
    """True when the lower-case line holds at least half of the question's telling words."""
    words = sorted(set(question.lower().split()) - set(fixed.QUESTION_STOP_WORDS))
    found = " + ".join(f"int(contains({line}, {quote(word)}))" for word in words) or "0"
    return f"2 * ({found}) >= {len(words)}"


def _question(number: int, question: str) -> str:
    return f"{number} AS question_no, {question_key(quote(question))} AS question_key"


def answers_in_lines(lines: DataFrame, questions: list[str]) -> DataFrame:
    """Answers from transcripts with one line per row: ``call_id``, ``line_no``, ``text``.

    The first matching line is a minimum per call, and the lines after it are fetched by an equi-join
    on call and line number, so even a call that holds most of the lines is spread over all tasks.
    """
    asked = [f"if({_is_asked('lower(text)', q)}, line_no, NULL) AS line_{i}" for i, q in enumerate(questions)]
    hits = [F.min(f"line_{i}").alias(f"hit_{i}") for i in range(len(questions))]
    first = lines.selectExpr("call_id", *asked).groupBy("call_id").agg(*hits)
    entries = ", ".join(f"struct({_question(i, q)}, hit_{i} AS hit)" for i, q in enumerate(questions))
    found = first.selectExpr("call_id", f"inline(array({entries}))")
    next_lines = f"posexplode(sequence(hit + 1, hit + {ANSWER_LINES})) AS (place, line_no)"
    following = found.filter("hit IS NOT NULL").selectExpr("call_id", "question_no", next_lines)
    texts = following.join(lines.selectExpr("call_id", "line_no", f"{clean('text')} AS text"), ["call_id", "line_no"])
    said = [F.expr(f"max(text) FILTER (WHERE place = {p})") for p in range(ANSWER_LINES)]
    answers = texts.groupBy("call_id", "question_no").agg(F.nullif(F.concat_ws(" ", *said), F.lit("")).alias("answer"))
    return found.drop("hit").join(answers, ["call_id", "question_no"], "left")


def answers_in_text(calls: DataFrame, transcript: str, questions: list[str]) -> DataFrame:
    """Calls with the answers from a transcript in one column, as an array with one entry per question.

    Works row by row, without any shuffle.  Lines are only looked at when the whole transcript holds
    enough of a question's words.
    """

    def hit(number: int, question: str) -> str:
        asked = f"transform(split(_lower, '\\n'), line -> {_is_asked('line', question)})"
        return f"int(if({_is_asked('_lower', question)}, array_position({asked}, true), 0)) AS _hit_{number}"

    def answer(number: int) -> str:
        after = f"transform(slice(_lines, _hit_{number} + 1, {ANSWER_LINES}), line -> {clean('line')})"
        return f"if(_hit_{number} > 0, nullif(array_join({after}, ' '), ''), NULL)"

    split = calls.selectExpr("*", f"split({transcript}, '\\n') AS _lines", f"lower({transcript}) AS _lower")
    entries = ", ".join(f"struct({_question(i, q)}, {answer(i)} AS answer)" for i, q in enumerate(questions))
    placed = split.selectExpr("*", *[hit(i, q) for i, q in enumerate(questions)])
    return placed.selectExpr(*calls.columns, f"array({entries}) AS answers")


def call_outcomes(calls: DataFrame) -> DataFrame:
    """Whether a person was reached and the call succeeded (``completed``, ``n_chars`` of the transcript)."""
    reached = F.coalesce(F.col("n_chars") > HUMAN_CHARS, F.lit(False))
    good = F.coalesce(F.col("completed"), F.lit(False)) & reached
    return calls.withColumns({"human_reached": reached, "call_successful": good, "needs_follow_up": ~good})


def transcript_sizes(lines: DataFrame) -> DataFrame:
    """Characters of each call's transcript, line breaks included."""
    return lines.groupBy("call_id").agg((F.sum(F.length("text")) + F.count("*") - 1).alias("n_chars"))


def merge_requirements(requirements: DataFrame, answers: DataFrame) -> DataFrame:
    """Known requirements (``state``, ``question_key``, ``answer``) with newer answers put over them.

    ``answers`` carries ``state``, ``question_key``, ``question_no``, ``answer`` and ``called_at``.  The latest call wins per
    question, also with an empty answer; only states that are already listed are updated.  A call raises the
    confidence of its whole state and sets the state's date of the last call.
    """
    listed = requirements.groupBy("state", "question_key").agg(F.max("answer").alias("old"))
    newest = F.max(F.struct("called_at", "question_no", "answer")).alias("new")
    latest = answers.groupBy("state", "question_key").agg(newest)
    latest = latest.join(requirements.select("state"), "state", "left_semi")
    called = latest.groupBy("state").agg(F.max("new.called_at").alias("last_call"))
    merged = listed.join(latest, ["state", "question_key"], "full_outer").join(called, "state", "left")
    return merged.select(
        "state",
        "question_key",
        F.when(F.col("new").isNotNull(), F.col("new.answer")).otherwise(F.col("old")).alias("answer"),
        F.to_date("last_call").alias("last_call_date"),
        F.when(F.col("last_call").isNotNull(), "medium").alias("data_confidence"),
    )


def save_transcripts(transcripts: DataFrame, path: str) -> None:
    """Transcripts as JSON lines by state and day."""
    transcripts.write.mode("append").partitionBy("state", "date").json(path)
