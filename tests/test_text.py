import json
import re

import pytest
from pyspark.sql import functions as F

from sievemill.functions import json_text, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("s", ["  a b\t", " x　", "\x1cq\x1f", "", "   ", "​kept​", "ΑΣ  "])
def test_strip_and_normalise_are_pythons(spark, s):
    assert value(spark, text.strip(F.lit(s))) == s.strip()
    assert value(spark, text.normalise(F.lit(s))) == s.strip().lower()


@pytest.mark.parametrize("s", ["$10,000 and 10,000", "15% of 15", "3, $3 and 3.50", "none", "1,23 ٣", "2.5.6%"])
def test_numbers(spark, s):
    got = value(spark, text.numbers(F.lit(s)))
    assert set(got) == set(re.findall(r"\$?\d+(?:,\d{3})*(?:\.\d+)?%?", s)) and len(got) == len(set(got))


def test_clean_markdown_goes_in_order(spark):
    # newlines are collapsed before tags are removed, so those that a tag leaves stay
    s = "Skip to main content\n\nA\n\n\n\nB\n\n<br>\n\n[go](javascript:void) [x](http://y)  "
    assert value(spark, text.clean_markdown(F.lit(s))) == "A\n\nB\n\n\n\ngo [x](http://y)"


def test_word_count(spark):
    for s in ["", "   ", "a", " a  b\nc "]:
        assert value(spark, text.word_count(F.lit(s))) == len(s.split())


@pytest.mark.parametrize(
    "url,expected",
    [("https://h/articles/12-how-to?x=1?y", ("12", "how-to", "https://h/articles/12-how-to")), ("https://h/articles/12-a#top", ("12", "a", "https://h/articles/12-a#top")), ("https://h/other", ("", "", "https://h/other"))],
)
def test_urls(spark, url, expected):
    got = spark.range(1).select(text.url_part(F.lit(url), "articles", "id"), text.url_part(F.lit(url), "articles", "slug"), text.strip_query(F.lit(url))).first()
    assert tuple(got) == expected


def test_link_rules(spark):
    assert value(spark, text.is_link(F.lit("/collections/1-a"), "collections")) and not value(spark, text.is_link(F.lit("collections/1-a"), "collections"))
    assert value(spark, text.is_link(F.lit("x/articles/1-a"), "articles"))
    assert value(spark, text.absolute(F.lit("/a"), "https://h")) == "https://h/a"


def test_slug_names_and_titles(spark):
    assert value(spark, text.slug_name(F.lit("2nd-tier"), {"a": "B"})) == "2Nd Tier"
    assert value(spark, text.slug_name(F.lit("a"), {"a": "B"})) == "B"
    assert value(spark, text.strip_title(F.lit("How to | Help Center - x"), "Help Center")) == "How to"


def test_fill_does_not_read_values(spark):
    t = "{{a}} {title}: {content}{{}}"
    got = value(spark, text.fill(t, title=F.lit("{content}"), content=F.lit("{{x}}")))
    assert got == t.format(title="{content}", content="{{x}}")


def test_dumps_is_pythons(spark):
    got = value(spark, json_text.dumps(F.struct(F.lit("é\n\U0001f600").alias("a"), F.array(F.lit(1), F.lit(2)).alias("b"))))
    assert got == json.dumps({"a": "é\n\U0001f600", "b": [1, 2]})


def _example(*contents, roles=("system", "user", "assistant")):
    return json.dumps({"messages": [{"role": r, "content": c} for r, c in zip(roles, contents, strict=True)]})


@pytest.mark.parametrize(
    "line,start",
    [
        (_example("a", "b", "c"), None), (_example("a", "", "c"), "Message 1 has empty content"), (_example("a", "b", "c", roles=("system", "assistant", "user")), "Message 1 should have role 'user', got 'assistant'"),
        ("{}", "Missing"), ('{"messages": 1}', "Messages should"), ('{"messages": []}', "Messages should"), ("", "Invalid JSON"), ("{'a': 1}", "Invalid JSON"), ('{"a": 1} x', "Invalid JSON"), ("[1]", "Missing"), ("3", "Missing"),
        ('{"messages": [1, 2, 3]}', "Message 0 should have role"), (None, "Invalid JSON"), ('{"messages": 1, "messages": []}', "Messages should"), (_example("a", "b", "c") + "\n", None),
    ],
)
def test_example_lines(line, start):
    got = json_text.example_error(line)
    assert got is None if start is None else got.startswith(start)


@pytest.mark.parametrize(
    "reply,n",
    [
        ('[{"question": "a?"}]', 1), ('Here:\n```json\n[{"question": "a?", "type": "t"}, {"question": "b"}]\n```\nbye ]', 2), ('```\n[{"question": "a"}]\n```', 1), ('so [{"question": "a"}] it is', 1), ('[{"question": "a"', 0),
        ('{"question": "a"}', 0), ("", 0), (None, 0), ("[]", 0), ('[1, {"type": "x"}, {"question": "q"}]', 1),
    ],
)
def test_question_replies(reply, n):
    assert len(json_text.parse_questions(reply)) == n


def test_question_fields():
    assert json_text.parse_questions('[{"question": "a", "type": 5}]') == [{"question": "a", "type": "5", "key_info_needed": None}]
