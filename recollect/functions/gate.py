"""Gate: which turns are worth embedding or storing.

Coverage of a message by closer words and phrases is a regular language over its words, so one anchored
expression on the space-joined words decides it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and phrases that close a conversation, and words that open a question.
CLOSER_WORDS = """
ok okay okey k kk thanks thx ty thanx thnks hi hello hey yo howdy sup bye cya ciao cheers later
np sure yep yup yeah nope lol lmao haha rofl yes no good great nice perfect cool morning afternoon evening night
""".split()
CLOSER_PHRASES = [
    "thank you", "thank you very much", "thank you so much", "thanks a lot", "thanks a bunch", "thanks a million",
    "good morning", "good morning everyone", "good afternoon", "good evening", "good evening everyone", "good night",
    "see you", "see ya", "no problem", "no worries", "sure thing", "sounds good",
]
QUESTION_LEADS = """
who what why how when where which whose whom is are was were am do does did can could should would will shall may might must
have has had explain help tell show describe clarify list
""".split()

MIN_RECALL_CHARS = 12
MIN_CONTENT_LETTERS = 4

CLOSER_PATTERN = "^(?:(?:" + "|".join(sorted(CLOSER_PHRASES + CLOSER_WORDS, key=lambda p: (-len(p), p))) + ")(?: |$))*$"


def letter_tokens(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


def is_closer(text: Column) -> Column:
    """No letters at all, or nothing but closers."""
    return F.array_join(letter_tokens(text), " ").rlike(CLOSER_PATTERN)


def skip_store(text: Column) -> Column:
    return is_closer(text)


def skip_recall(text: Column, min_chars: int = MIN_RECALL_CHARS) -> Column:
    """Closers, and short turns that neither ask nor hold a word of some length."""
    tokens = letter_tokens(text)
    asks = F.contains(text, F.lit("?")) | F.coalesce(F.get(tokens, 0).isin(QUESTION_LEADS), F.lit(False))
    content = F.exists(tokens, lambda t: F.length(t) >= MIN_CONTENT_LETTERS)
    short = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")) < min_chars
    return is_closer(text) | (short & ~asks & ~content)
