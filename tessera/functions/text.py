"""Column expressions for words in text (JVM regex, no Python UDF).

Word rules (per language):
  * case is ignored (text is lower-cased);
  * characters outside the language's letters are deleted, except white
    space (token boundaries) and the hyphen;
  * a word is letters, optionally joined by single hyphens inside the word
    (``well-known`` yes; ``a--b`` and ``-x-`` no);
  * one-letter words are kept only when listed for the language;
  * words containing a banned substring are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alphabets and word rules of the two article languages and
# of the other languages of the supplied ``documents`` table.
ENGLISH_LETTERS = "abcdefghijklmnopqrstuvwxyz"
FINNISH_EXTRA_LETTERS = "åäö"
GERMAN_EXTRA_LETTERS = "äöüß"
FRENCH_EXTRA_LETTERS = "àâæçèéêëîïôœùûüÿ"
SPANISH_EXTRA_LETTERS = "áéíñóúü"
ENGLISH_ONE_LETTER_WORDS = ("a", "i")
FRENCH_ONE_LETTER_WORDS = ("a", "à", "y")
SPANISH_ONE_LETTER_WORDS = ("a", "e", "o", "u", "y")
FINNISH_BANNED_SUBSTRINGS = ("wiki",)

WHITESPACE_RUN = r"\s+"
NON_WHITESPACE_RUN = r"\S+"


@dataclass(frozen=True)
class WordRules:
    letters: str
    one_letter_words: tuple[str, ...] = ()
    banned_substrings: tuple[str, ...] = ()

    @property
    def disallowed_pattern(self) -> str:
        return f"[^{self.letters}\\s-]"


ENGLISH = WordRules(ENGLISH_LETTERS, ENGLISH_ONE_LETTER_WORDS)
FINNISH = WordRules(ENGLISH_LETTERS + FINNISH_EXTRA_LETTERS, (), FINNISH_BANNED_SUBSTRINGS)
GERMAN = WordRules(ENGLISH_LETTERS + GERMAN_EXTRA_LETTERS, (), FINNISH_BANNED_SUBSTRINGS)
FRENCH = WordRules(ENGLISH_LETTERS + FRENCH_EXTRA_LETTERS, FRENCH_ONE_LETTER_WORDS)
SPANISH = WordRules(ENGLISH_LETTERS + SPANISH_EXTRA_LETTERS, SPANISH_ONE_LETTER_WORDS)
LANGUAGE_RULES = {"en": ENGLISH, "fi": FINNISH, "de": GERMAN, "fr": FRENCH, "es": SPANISH}


def strip_disallowed(text: Column, rules: WordRules) -> Column:
    """Lower-case and delete every character that is not a letter of the
    language, white space or a hyphen. Deleting keeps token boundaries, so
    this equals cleaning each white-space token separately."""
    return F.regexp_replace(F.lower(text), rules.disallowed_pattern, "")


def is_word(word: Column, rules: WordRules) -> Column:
    """True when a cleaned token is a word under ``rules``. Only letters and
    hyphens are left in it, so where the hyphens stand decides; no regular
    expression, whose recursion a token of thousands of hyphens would exhaust."""
    cond = (word != "") & ~word.startswith("-") & ~word.endswith("-") & ~word.contains("--")
    if rules.one_letter_words:
        cond = cond & ((F.length(word) > 1) | word.isin(*rules.one_letter_words))
    else:
        cond = cond & (F.length(word) > 1)
    for banned in rules.banned_substrings:
        cond = cond & ~word.contains(banned)
    return cond


def whitespace_split(text: Column) -> Column:
    """Array of the white-space separated tokens (may hold empty strings at
    the ends; filter them or test tokens afterwards)."""
    return F.split(text, WHITESPACE_RUN)


def token_count(text: Column) -> Column:
    """Number of white-space separated tokens."""
    return F.regexp_count(text, F.lit(NON_WHITESPACE_RUN))


def line_count(text: Column, separator: str = "\n") -> Column:
    """Number of lines (pieces between separators, empty ones included)."""
    return F.length(text) - F.length(F.replace(text, F.lit(separator), F.lit(""))) + 1


def non_space_length(text: Column) -> Column:
    """Number of characters that are not white space (tabs and newlines are
    white space too, not only the blank)."""
    return F.length(F.regexp_replace(text, r"\s", ""))
