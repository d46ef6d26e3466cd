"""Text normalisation and tokens."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"

# Spellings that share one canonical title.
TITLE_SYNONYMS = {
    "Data Scientist": ["data scientist"],
    "Machine Learning Engineer": ["ml engineer", "machine learning engineer"],
    "Full Stack Developer": ["full stack developer", "fullstack developer"],
    "Backend Developer": ["backend developer"],
    "Frontend Developer": ["frontend developer"],
    "DevOps Engineer": ["devops engineer"],
    "Site Reliability Engineer": ["sre", "site reliability engineer"],
}

# Spellings that share one canonical city.
CITY_SYNONYMS = {
    "Bangalore": ["bangalore", "bengaluru", "blr"],
    "Mumbai": ["mumbai", "bombay", "bom"],
    "Delhi": ["delhi", "new delhi", "ncr"],
    "Gurgaon": ["gurgaon", "gurugram"],
    "Hyderabad": ["hyderabad", "hyd"],
}

# A run of letters, their marks and digits with inner dots and trailing + or #, else one other visible character. Marks
# belong to the run, so that lower case (which turns one letter into a letter and a mark at times) cuts no token in two.
TOKEN_PATTERN = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*(?:\.[\p{L}\p{N}][\p{L}\p{M}\p{N}]*)*[+#]*|[^\s\p{L}\p{N}]"

# The same for Spark's own expressions: no part is given back once it is taken, so a long run needs no deep stack.
TOKEN = (
    r"(?:[\p{L}\p{N}][\p{L}\p{M}\p{N}]*+(?:\.[\p{L}\p{N}][\p{L}\p{M}\p{N}]*+)*+[+#]*+|[^\s\p{L}\p{N}])"
)


def normalize_text(text: Column) -> Column:
    """Lower case, single blanks, no outer blanks; null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), F.lit(""))


def canonical_name(text: Column, synonyms: dict[str, list[str]]) -> Column:
    """Whole-string synonym lookup; other names in title case, null or blank as ``Unknown``.

    The lookup is a chain of IN lists, so it needs neither a join nor a shuffle.
    """
    key = normalize_text(text)
    chain = F.when(key == "", F.lit(UNKNOWN))
    for name, spellings in synonyms.items():
        chain = chain.when(key.isin(spellings), F.lit(name))
    return chain.otherwise(F.initcap(key))


def normalize_title(title: Column, synonyms: dict[str, list[str]] | None = None) -> Column:
    return canonical_name(title, TITLE_SYNONYMS if synonyms is None else synonyms)


def normalize_location(location: Column, synonyms: dict[str, list[str]] | None = None) -> Column:
    return canonical_name(location, CITY_SYNONYMS if synonyms is None else synonyms)


def tokens(text: Column) -> Column:
    """Lower-cased tokens in order, null for null text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def phrase_key(text: Column) -> Column:
    """The form in which phrases and texts are compared: tokens joined by one blank."""
    return F.array_join(tokens(text), " ")


@lru_cache(maxsize=1)
def _written_as() -> dict[str, str]:
    """For each character those that lower case turns into it."""
    forms = {"\u03c2": "\u03a3"}
    for char in map(chr, range(sys.maxunicode + 1)):
        if (low := char.lower()) != char:
            forms[low] = forms.get(low, "") + char
    return forms


def _parts(key: str) -> list[str]:
    """Expressions for the characters of a phrase, its blanks and the ends of its words, in any case."""
    parts, dot = [], "\u0307"
    for word in key.split(" "):
        for before, char in zip(" " + word, word):
            own = char if char.isalnum() or not char.isascii() else "\\" + char
            # Lower case makes two characters of one letter only, the dotted capital I. \p{Cn}: letters newer than these tables.
            more = "\u0130" if char == "i" and dot in word else "" if char.isascii() else r"\p{Cn}"
            parts.append(f"[{own}{_written_as().get(char, '')}{more}]" + "?" * (before == "i" and char == dot))
        parts.append(("(?![a-zA-Z0-9])" if word[-1].isascii() and word[-1].isalnum() else "") + r"\s*+")
    return [*parts[:-1], parts[-1].removesuffix(r"\s*+")]


def may_begin(keys: list[str], depth: int = 4) -> str:
    """An expression that holds wherever one of the phrases begins, and at a few other places.

    Phrases are told apart by their first characters, so a place costs little more for many of them than for one.
    """

    def branch(rests: list[list[str]], depth: int) -> str:
        if not all(rests):
            return ""
        if not depth or len(rests) == 1:
            return "|".join(map("".join, rests))
        heads: dict[str, list[list[str]]] = {}
        for rest in rests:
            heads.setdefault(rest[0], []).append(rest[1:])
        return "|".join(f"{head}(?:{branch(tails, depth - 1)})" for head, tails in heads.items())

    rests = sorted(map(_parts, set(keys)))
    first = "".join(sorted({rest[0].removesuffix("?")[1:-1] for rest in rests}))
    return f"(?=[{first}])(?:{branch(rests, depth)})"


def pieces(text: Column, keys: list[str]) -> Column:
    """The text cut before each place where one of the phrases may begin; the pieces together are the text."""
    others = rf"(?:\s*+(?!{may_begin(keys)}){TOKEN})*+" if keys else rf"(?:\s*+{TOKEN})*+"
    return F.regexp_extract_all(text, F.lit(rf"^\s++|{TOKEN}{others}\s*+"), F.lit(0))


#: Characters of a block of a text.
BLOCK_CHARS = 1024


def blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def cut(parts: Column, start: Column, length: Column) -> Column:
    """What ``substring`` takes from the text of these ``blocks``, from character ``start`` (0: the first) on.

    It reads the blocks it needs, so many cuts in a long text do not each walk through all that lies before them.
    """
    block = F.floor(start / BLOCK_CHARS).cast("int")
    last = F.floor((start + length - 1) / BLOCK_CHARS).cast("int")
    held = F.array_join(F.slice(parts, block + 1, F.greatest(last - block + 1, F.lit(0))), "")
    return F.substring(held, (start - block * BLOCK_CHARS + 1).cast("int"), length.cast("int"))
