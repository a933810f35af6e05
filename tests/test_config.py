import pytest

from askloom.config import PROMPT_TEMPLATE, Settings


def test_defaults():
    s = Settings()
    assert (s.chunk_size, s.chunk_overlap, s.top_k, s.temperature, s.quality_threshold) == (800, 100, 6, 0.3, 0.5)
    assert s.overlap_ratio < 0.5


@pytest.mark.parametrize("bad", [
    {"chunk_size": 0}, {"chunk_overlap": -1}, {"chunk_overlap": 800}, {"chunk_overlap": 400}, {"top_k": 0},
    {"temperature": 1.1}, {"temperature": -0.1}, {"quality_threshold": 2}, {"docs_folder": ""},
    {"prompt_template": "{context} {question}"},
])
def test_bad_values(bad):
    with pytest.raises(ValueError):
        Settings(**bad)


def test_template_has_all_placeholders():
    assert all("{%s}" % p in PROMPT_TEMPLATE for p in ("context", "chat_history", "question"))
