"""Grading of submissions against gold: a status, and a reward that is null only where nothing was graded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import fixed
from sievemill.functions.literals import disease_keys
from sievemill.operators.validate import has_exact_keys, strict_bool, strict_int, strict_number, strict_object, strict_string


def _reward(correct: Column) -> Column:
    return F.when(F.coalesce(correct, F.lit(False)), 1.0).otherwise(0.0)


def letter(submission: Column, letters: Column, gold: Column) -> Column:
    """One capital letter among the options, one newline at most after it."""
    bare = F.regexp_extract(submission, r"\A([A-Z])\n?\z", 1)
    return _reward((bare != "") & F.array_contains(letters, bare) & (bare == gold))


def lenient_text(submission: Column, gold: Column, subjective: Column) -> Column:
    """Equal without regard to case and outer spaces; a subjective question takes any answer that isn't empty."""
    said = F.trim(submission)
    return _reward(F.when(subjective, said != "").otherwise(F.upper(said) == F.upper(F.trim(gold))))


def json_letter(submission: Column, key: str, allowed: list[str], gold: Column) -> Column:
    value = strict_string(strict_object(submission), f"$.{key}")
    return _reward(has_exact_keys(submission, [key]) & value.isin(*allowed) & (value == gold))


def json_bool(submission: Column, key: str, gold: Column) -> Column:
    """struct(status correct | incorrect | invalid, reward)."""
    value = F.when(has_exact_keys(submission, [key]), strict_bool(strict_object(submission), f"$.{key}"))
    status = F.when(value.isNull(), "invalid").when(value == gold, "correct").otherwise("incorrect")
    return F.struct(status.alias("status"), _reward(status == "correct").alias("reward"))


def json_int(submission: Column, key: str, upper: Column, gold: Column) -> Column:
    """An integer from 0 to upper, equal to gold."""
    value = strict_int(strict_object(submission), f"$.{key}")
    return _reward(has_exact_keys(submission, [key]) & value.between(F.lit(0), upper) & (value == gold))


def label_and_names(submission: Column, label: Column, names: Column) -> Column:
    """struct(format, pathogenicity, diseases, reward) of {"pathogenicity": .., "diseases": [..]}; names compare as sets of folded keys."""
    whole = strict_object(submission)
    said = strict_string(whole, "$.pathogenicity")
    typed = F.schema_of_variant(F.try_variant_get(whole, "$.diseases", "variant"))
    listed = F.when((typed == "ARRAY<STRING>") | (typed == "ARRAY<VOID>"), F.try_variant_get(whole, "$.diseases", "array<string>"))
    keys = disease_keys(listed)
    fits = F.coalesce(has_exact_keys(submission, ["pathogenicity", "diseases"]) & said.isin(*fixed.LABELS) & listed.isNotNull() & ~F.array_contains(keys, "") & F.forall(listed, lambda x: x.isNotNull()), F.lit(False))
    same, equal = fits & (said == label), fits & (keys == disease_keys(names))
    return F.struct(_reward(fits).alias("format"), _reward(same).alias("pathogenicity"), _reward(equal).alias("diseases"), _reward(fits & same & equal).alias("reward"))


def tagged(submission: Column, mode: Column, low: Column, high: Column, text: Column) -> Column:
    """struct(status missing | malformed | graded | unsupported_judge_required, reward): a number within [low, high] or a text, inside one answer tag."""
    answer = F.trim(F.regexp_extract(submission, fixed.ANSWER_TAG, 1))
    number = F.regexp_replace(answer, "(?<=[0-9])_(?=[0-9])", "").try_cast("decimal(38,18)")
    supported = mode.isin("range_verifier", "str_verifier")
    status = F.when(submission.isNull(), "missing").when(~submission.rlike(fixed.ANSWER_TAG), "malformed").when(~supported, "unsupported_judge_required").otherwise("graded")
    correct = F.when(mode == "range_verifier", number.between(low, high)).otherwise(answer == F.trim(text))
    return F.struct(status.alias("status"), _reward((status == "graded") & correct).alias("reward"))


def ordinal_verdict(verdict: Column) -> Column:
    """Score of {"score": 0 | .25 | .5 | .75 | 1, "rationale": text}; null where the verdict breaks its contract."""
    whole = strict_object(verdict, 65_536)
    score, why = strict_number(whole, "$.score"), strict_string(whole, "$.rationale")
    return F.when(has_exact_keys(verdict, ["score", "rationale"]) & score.isin(0.0, 0.25, 0.5, 0.75, 1.0) & (F.trim(why) != ""), score)


def binary_verdict(verdict: Column) -> Column:
    """Score of {"answer_correct": bool, "score": 0 | 1, "rationale": 1 to 1200 characters}, both agreeing; else null."""
    whole = strict_object(verdict, 65_536)
    flag, score, why = strict_bool(whole, "$.answer_correct"), strict_int(whole, "$.score"), strict_string(whole, "$.rationale")
    return F.when(has_exact_keys(verdict, ["answer_correct", "score", "rationale"]) & (score == flag.cast("long")) & F.length(F.trim(why)).between(1, 1200), score.cast("double"))


def outcome(reward: Column, invalid: Column, infrastructure: Column) -> Column:
    """struct(status, reward): an invalid submission scores 0; where the infrastructure failed there is no score."""
    status = F.when(infrastructure, "infrastructure_error").when(invalid, "invalid_submission").otherwise("graded")
    return F.struct(status.alias("status"), F.when(status == "graded", reward).when(status == "invalid_submission", 0.0).alias("reward"))


def judge_reply(body: Column) -> Column:
    """Text of the first choice of a response body; null where there is none. ordinal_verdict and binary_verdict read it."""
    whole = F.try_parse_json(body)
    return F.try_variant_get(whole, "$.choices[0].message.content", "string")


def judged(rows: DataFrame, request: str, send: Callable[[str], str], tries: int = 3) -> DataFrame:
    """rows with body and error of their requests. send posts a request and returns the response's body; offline it is
    any function of the request. Equal requests are sent once; an exception is tried again, then told in error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame[request]:
                body = error = None
                for _ in range(tries):
                    try:
                        body, error = send(text), None
                        break
                    except Exception as e:  # noqa: BLE001, whatever the sender raises
                        error = f"{type(e).__name__}: {e}"
                out.append((text, body, error))
            yield pd.DataFrame(out, columns=[request, "body", "error"])

    asked = rows.select(request).where(F.col(request).isNotNull()).distinct()
    return rows.join(asked.mapInPandas(run, f"`{request}` string, body string, error string"), request, "left")


def judge_request(model: str, instructions: str, untrusted: dict[str, Column]) -> Column:
    """Request body with instructions apart from untrusted data; judged sends it."""
    data = F.to_json(F.struct(*[c.alias(n) for n, c in untrusted.items()]))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("system").alias("role"), F.lit(instructions).alias("content")), F.struct(F.lit("user").alias("role"), data.alias("content"))).alias("messages")))
