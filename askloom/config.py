"""All parameters of the ingest, ask and evaluate flows."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Defaults that results depend on.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", " ", "")
TOP_K = 6
EMBEDDING_DIM = 384
EXTENSIONS = (".pdf", ".docx", ".txt")
QUALITY_THRESHOLD = 0.5
METRIC_TIME_LIMIT = 1200.0
MIN_HIT_CHARS = 50
EXCERPT_CHARS = 400
UNKNOWN_SOURCE = "unknown"
UNKNOWN_PAGE = "—"
LABEL_PASS = "✅ ACCEPTABLE"
LABEL_FAIL = "❌ INSUFFISANT"

PLACEHOLDERS = ("context", "chat_history", "question")

PROMPT_TEMPLATE = """Answer the question below for the reader of a document collection.
Rely on the passages first and name the file a fact comes from.
Where the passages are silent, say so, then add what is generally known.
Read the earlier turns to resolve what a follow-up question refers to.

Passages:
{context}

Earlier turns:
{chat_history}

Question: {question}

Answer:"""

TRANSLATION_TEMPLATE = """Give the English wording of this French question.
Reply with the translated question alone.

{question}
"""

FOLLOW_UP_TEMPLATE = """Earlier turns of a conversation:
{chat_history}

Word the next question so that it is understood without them.
Reply with that question alone.

{question}
"""

BACK_QUESTION_TEMPLATE = """Which question does this text answer?
Reply with the question alone.

{answer}
"""


@dataclass(frozen=True)
class Settings:
    """Validated parameter set; the defaults are the fixed values above."""

    docs_folder: str = "documents"
    index_path: str = "vectorstore"
    embedding_model: str = "hashed-token-counts"
    generator_model: str = "extractive"
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
    top_k: int = TOP_K
    temperature: float = 0.3
    quality_threshold: float = QUALITY_THRESHOLD
    time_limit: float | None = None  # seconds for one call of the embedder, the translator or the generator
    metric_time_limit: float | None = METRIC_TIME_LIMIT  # seconds for one call of a hook that scores answers
    prompt_template: str = field(default=PROMPT_TEMPLATE, repr=False)

    def __post_init__(self) -> None:
        check_chunking(self.chunk_size, self.chunk_overlap)
        if not self.overlap_ratio < 0.5:
            raise ValueError("chunk_overlap must be below half of chunk_size")
        if self.top_k <= 0:
            raise ValueError("top_k must be positive")
        if not 0 <= self.temperature <= 1:
            raise ValueError("temperature must lie in [0, 1]")
        if not 0 <= self.quality_threshold <= 1:
            raise ValueError("quality_threshold must lie in [0, 1]")
        for label in ("docs_folder", "index_path", "embedding_model", "generator_model"):
            if not getattr(self, label):
                raise ValueError(f"{label} must not be empty")
        missing = set(PLACEHOLDERS) - set(re.findall(r"\{(\w+)\}", self.prompt_template))
        if missing:
            raise ValueError(f"prompt_template lacks {sorted(missing)}")

    @property
    def overlap_ratio(self) -> float:
        return self.chunk_overlap / self.chunk_size


def check_chunking(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("chunk overlap must lie in [0, chunk size)")
