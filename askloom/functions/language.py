"""French / English detection by marker words."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from askloom.functions.text import as_column

# A marker counts once, wherever it occurs in the lower-cased text.
FRENCH_MARKERS = (
    "c'est", "quoi", "qu'est", "comment", "pourquoi", "quel",
    "quelle", "quels", "quelles", "est-ce", "expliquez", "décrivez",
    "donnez", "listez", "définissez", "différence", "avantages",
    "inconvénients", "utilisez", "fonctionne", "qu'", "les", "des",
    "une", "un", "le", "la",
)
MIN_MARKERS = 2


def french_markers(text: Column | str) -> Column:
    lowered = F.lower(as_column(text))
    return reduce(add, (F.contains(lowered, F.lit(m)).cast("int") for m in FRENCH_MARKERS))


def detect_language(text: Column | str) -> Column:
    return F.when(french_markers(text) >= MIN_MARKERS, "fr").otherwise("en")
