"""Prompt texts, request and response JSON, and number formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The two prompts, their fields, the request version and the limits of an answer, which the answers depend on.
DESCRIBE_PROMPT = (
    "Write a short, fluent sentence that assesses the applicant's creditworthiness. "
    "Avoid starting with generic phrases like 'Based on the information'. "
    "Be clear, direct, and sound like a human credit analyst.\n\n"
    "Here are the applicant’s details:\n"
)
DESCRIBE_FIELDS = (
    ("Age", "age"), ("Sex", "sex"), ("Job", "job"), ("Housing", "housing"), ("Saving accounts", "saving_accounts"),
    ("Checking account", "checking_account"), ("Credit amount", "credit_amount"), ("Duration", "duration"),
    ("Purpose", "purpose"),
)
CLASSIFY_PROMPT = (
    "Read this creditworthiness assessment and classify it as either 'good risk' or 'bad risk'. "
    "Respond with ONLY one of those two labels.\n\n"
    "Be very critic, you are the most experienced risk evaluator in the world. Your decision is the final one."
    'Assessment: "{}"\n\nLabel:'
)
REQUEST_VERSION = ("anthropic_version", "bedrock-2023-05-31")
DESCRIBE_LIMITS = {"max_tokens": 250, "temperature": 0.7}
CLASSIFY_LIMITS = {"max_tokens": 10, "temperature": 0.0}
MISSING_TEXT = "nan"


def describe_prompt(fields: Sequence[tuple[str, str]] = DESCRIBE_FIELDS) -> Column:
    """The description prompt with one ``- Name: value`` line per field."""
    lines = [
        F.concat(F.lit(f"- {title}: "), F.coalesce(F.col(name).cast("string"), F.lit(MISSING_TEXT)))
        for title, name in fields
    ]
    return F.concat(F.lit(DESCRIBE_PROMPT), F.concat_ws("\n", *lines))


def classify_prompt(description: Column) -> Column:
    before, after = CLASSIFY_PROMPT.split("{}")
    return F.concat(F.lit(before), F.coalesce(description, F.lit(MISSING_TEXT)), F.lit(after))


def request_body(prompt: Column, max_tokens: int, temperature: float) -> Column:
    """The JSON request with one user message."""
    name, version = REQUEST_VERSION
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(
        F.struct(
            F.lit(version).alias(name),
            F.array(message).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )


def response_body(text: Column) -> Column:
    """A response that carries ``text`` as its first content item."""
    return F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("content")))


def response_text(body: Column) -> Column:
    """Text of the first content item; null when the body has none."""
    content = F.from_json(body, "content array<struct<text string>>")["content"]
    return F.get(content, F.lit(0))["text"]


def preview(text: Column, chars: int = 200) -> Column:
    return F.substring(text, 1, chars)


def class_at(probability: Column, threshold: float = 0.5) -> Column:
    """Class 1 above the threshold, else 0."""
    return F.when(probability > threshold, 1).otherwise(0)
