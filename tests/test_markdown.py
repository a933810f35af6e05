import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from askloom.operators.markdown import fence_state, length_report, markdown_blocks


def by_definition(text):
    """Line by line with a flag for the fence."""
    out, held = [], None
    for line in text.split("\n"):
        s = line.strip()
        if s[:3] == "```":
            if held is None:
                held = []
            else:
                out.append(("code", "\n".join(held)))
                held = None
        elif held is not None:
            held.append(line)
        elif not s:
            out.append(("blank", ""))
        elif match := re.match(r"(#{1,3}) ", s):
            out.append((f"h{len(match[1])}", s[len(match[0]):]))
        elif s[:2] in ("- ", "* ", "• "):
            out.append(("bullet", s[2:]))
        elif re.match(r"\d+\.\s", s) and len(s) < 300:
            out.append(("numbered", s))
        elif re.match("(note|tip|important|warning):", s, re.I):
            out.append(("note", s))
        else:
            out.append(("body", s))
    return out


SAMPLE = """# Title
  ## Part\t
### Sub
#### deeper
- item
* star
• dot
1. step
12.\ttab
1.no
NOTE: look
Tip: x
plain

```python
# not a heading
  indented
```
after
``` inline
x
"""


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = {i: [] for i in range(len(texts))}
    for r in markdown_blocks(df).orderBy("id", "block_no").collect():
        assert r.block_no == len(out[r.id])
        out[r.id].append((r.kind, r.text))
    return [out[i] for i in range(len(texts))]


def test_sample(spark):
    numbered = ["1. " + "x" * 296, "1. " + "x" * 297]
    texts = [SAMPLE, "", "```\n```", "```", "a\n```\n\n```\nb", "\n\n", *numbered]
    assert found(spark, texts) == [by_definition(t) for t in texts]
    assert [found(spark, [n])[0][0][0] for n in numbered] == ["numbered", "body"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(
    ["```", " ```sh", "# a", "## b", "- c", "1. d", "note: e", "f ```", "", "  ", "\tg", "é"]), max_size=12).map("\n".join), min_size=20, max_size=30))
def test_random_documents(spark, texts):
    assert found(spark, texts) == [by_definition(t) for t in texts]


def test_fence_state(spark):
    df = spark.createDataFrame([(SAMPLE,)], "text string")
    inside = [r.line for r in fence_state(df).where("in_code").orderBy("segment_no", "line_no").collect()]
    assert inside == ["# not a heading", "  indented", "x", ""]


def test_no_shuffle(spark):
    df = spark.createDataFrame([(SAMPLE,)], "text string")
    assert "Exchange" not in markdown_blocks(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text, chars, words", [("a b\nc", 5, 3), ("", 0, 0)])
def test_lengths(spark, text, chars, words):
    row = length_report(spark.createDataFrame([("d", text)], "source string, text string")).head()
    assert (row.source, row.n_chars, row.n_words) == ("d", chars, words)
