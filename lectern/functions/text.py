"""Cleaning, tokens, sentences and sections of transcript text, as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Punctuation, filler words, prompt vocabulary and headings of the transcript corpus.
ALLOWED_PUNCT = ",.!?%—–…«»*':;-"
FILLER_WORDS = ("ну", "э", "эм", "эмм", "ммм", "мм", "ыыы", "эээ", "ээ", "um", "umm", "uh", "uhh")
PROMPT_VOCABULARY = (
    "вытяжени[ея]", "ось", "текстура", "импульс", "амплитуда", "многозадачность", "бедра", "копчик", "кагами", r"практика\s+контемпорари",
    r"двигательной(?:\s+импровизации)?", "thread of the arms", "thread of the legs", "full body experience", "range", "flow", "vibe", "groove",
)
CORE_TERMS = ("ось", "текстура", "импульс", "амплитуда", "многозадачность", "бедра")
ENGLISH_TAIL = ("flow", "vibe", "groove")
ANCHORS = ("кагами", r"практика\s+контемпорари", r"двигательной\s+импровизации")
LIST_HEADS = ("термины", "вытяжени[ея]")
TOPICS_HEADING = "## Затронутые темы"
EVIDENCE_MARKS, EVIDENCE_PLAIN, EVIDENCE_DROPPED = "«»“”‘’–—", "\"\"\"\"''--", "*_`"
NO_TOPICS = "Нет выделенных тем."

#: The white space of Unicode text processing, for Java patterns: 29 characters, more than Java's own class.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NOT_SPACE = SPACE.replace("[", "[^", 1)


def _java(pattern: str) -> str:
    """A pattern with the white-space classes spelt out."""
    return pattern.replace(r"\S", NOT_SPACE).replace(r"\s", SPACE)


def _any(terms: tuple[str, ...]) -> str:
    return "(?:" + "|".join(terms) + ")"


# Fixed patterns: subtitle credits, prompt echoes and vocabulary lists of the transcript corpus.
#: Case-insensitive with Unicode case and Unicode word boundaries.
_FOLD = "(?iuU)"
CREDITS = _java(r"[Рр]едактор субтитров\s+\S+\s+[Кк]орректор\s+\S+\.?|[Сс]убтитры\s+\S+\s+DimaTorzok\.?")
ECHO = _FOLD + _java(rf"(?:\b{_any((*PROMPT_VOCABULARY, 'термины'))}\b[,.:]?\s*(?:и\s+)?){{3,}}")
ANCHOR = _FOLD + _java(_any(ANCHORS))
VOCABULARY_LIST = _FOLD + _java(rf"\b{_any(LIST_HEADS)}[,:]?\s*(?:\b{_any(PROMPT_VOCABULARY)}\b\s*,\s*)+(?:\b{_any(PROMPT_VOCABULARY)}\b)\s*\.?")
CORE = _FOLD + rf"\b{_any(CORE_TERMS)}\b"
TAIL = _FOLD + rf"\b{_any(ENGLISH_TAIL)}\b"
OUTSIDE_ALPHABET = "[^0-9A-Za-zА-Яа-яЁё" + ALLOWED_PUNCT.replace("-", "") + "-]+"
#: A negated class costs Java about ten times as much as its runs.
ALPHABET_RUN = OUTSIDE_ALPHABET.replace("^", "", 1)
#: What every credit, anchor and head of a list has a letter of, in any case: texts without one are passed through.
CYRILLIC = r"[\u0400-\u052f\u1c80-\u1c8f]"


def strip(x: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(x, rf"(?s)\A{SPACE}+|{SPACE}+\z", "")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, with ``x`` computed once however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def replace_if(x: Column, pattern: str, condition: Callable[[Column], Column], needs: str, by: str = " ") -> Column:
    """Matches of ``pattern`` that meet ``condition`` become ``by``: gaps and matches are zipped, as a match alone cannot call a function.

    ``needs``: a plain pattern that every text with such a match has, and with it a Cyrillic letter; texts without it are passed through."""

    def change(t: Column) -> Column:
        gaps = F.split(t, pattern, -1)
        matches = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: F.when(condition(m), F.lit(by)).otherwise(m))
        return F.when(t.rlike(CYRILLIC) & t.rlike(needs), F.array_join(F.zip_with(gaps, F.concat(matches, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")).otherwise(t)

    return let(x, change)


def strip_credits(x: Column) -> Column:
    return F.when(x.rlike(CYRILLIC), F.regexp_replace(x, CREDITS, " ")).otherwise(x)


def strip_prompt_echo(x: Column) -> Column:
    """Runs of three or more prompt terms that hold an anchor."""
    return replace_if(x, ECHO, lambda m: m.rlike(ANCHOR), ANCHOR)


def is_vocabulary_list(span: Column) -> Column:
    """Four core terms, or three and an English tail."""
    core = F.size(F.regexp_extract_all(span, F.lit(CORE), F.lit(0)))
    return (core >= 4) | ((core >= 3) & span.rlike(TAIL))


def strip_vocabulary_list(x: Column) -> Column:
    return replace_if(x, VOCABULARY_LIST, is_vocabulary_list, _FOLD + _any(LIST_HEADS))


def keep_alphabet(x: Column) -> Column:
    """Runs of other characters and of white space become one space; ends are trimmed."""
    return F.array_join(F.regexp_extract_all(x, F.lit(ALPHABET_RUN), F.lit(0)), " ")


def clean_text(x: Column) -> Column:
    """Credits, prompt echoes, vocabulary lists and foreign characters go, in this order."""
    return keep_alphabet(strip_vocabulary_list(strip_prompt_echo(strip_credits(x))))


def tokens(clean: Column) -> Column:
    return F.array_remove(F.split(clean, " "), "")


def word_count(x: Column) -> Column:
    """Words of raw text, by Unicode white space."""
    return F.size(F.array_remove(F.split(x, SPACE + "+"), "")).cast("long")


def normalize_word(w: Column) -> Column:
    return F.lower(F.btrim(w, F.lit(ALLOWED_PUNCT)))


def drop_fillers(words: Column) -> Column:
    return F.filter(words, lambda w: ~normalize_word(w).isin(*FILLER_WORDS))


def drop_mixed_script(words: Column) -> Column:
    """Without tokens that have both a Cyrillic and a Latin letter."""
    return F.filter(words, lambda w: ~(w.rlike("[А-Яа-яЁё]") & w.rlike("[A-Za-z]")))


def sentences(x: Column) -> Column:
    """Pieces after . ! ? …, stripped, without blank ones."""
    pieces = F.split(x, rf"(?<=[.!?…]){SPACE}+", -1)
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def paragraphs(found: Column, size: int) -> Column:
    """Groups of ``size`` sentences, joined by spaces, between blank lines; no sentences: an empty text."""

    def grouped(s: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1)), F.lit(size))
        return F.array_join(F.transform(starts, lambda i: F.array_join(F.slice(s, i, size), " ")), "\n\n")

    return let(found, grouped)


def titled(title: Column, section: str, body: Column) -> Column:
    return F.concat(F.lit("# "), title, F.lit(f"\n\n## {section}\n\n"), strip(body), F.lit("\n"))


def with_suffix(name: Column, old: str, new: str) -> Column:
    """The last suffix alone is changed."""
    return F.regexp_replace(name, rf"\Q{old}\E\z", new)


def passages(x: Column) -> Column:
    """(id, text) of stripped, non-blank pieces after . ! ? and at newlines; ids are p1, p2, ... without gaps."""
    pieces = F.filter(F.transform(F.split(x, rf"(?<=[.!?]){SPACE}+|\n+", -1), strip), lambda s: s != "")
    return F.transform(pieces, lambda s, i: F.struct(F.concat(F.lit("p"), (i + 1).cast("string")).alias("id"), s.alias("text")))


def _arrow_text(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """A Column function that works on the texts in Arrow batches. The UDF is made anew for each column: one that has been used holds the JVM, and modules, which
    travel to workers by value, could not be pickled with it."""

    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda s: None if s is None else function(s))

    return lambda x: F.pandas_udf(run, T.StringType())(x)


#: Unicode composition and case folding, which Spark has no functions for.
_compose = _arrow_text(lambda s: unicodedata.normalize("NFC", s))
casefold = _arrow_text(str.casefold)

#: Characters that composition can change or move, or that can join the one before; some others between them are in it too. No other character changes, and what
#: stands before and after one that is not in it composes apart.
_COMPOSING = (
    r"\u0300-\u0387\u0483-\u0487\u0591-\u0e4b\u0eb8-\u0ecb\u0f18-\u109d\u1161-\u1dff\u1f70-\u2001\u20d0-\u20ff\u2126-\u212b\u2329\u232a\u2adc\u2cef-\u2cf1\u2d7f\u2de0-\u2dff"
    r"\u302a-\u302f\u3099\u309a\ua66f-\uabed\uf900-\ufb4e\ufe20-\ufe2f\x{10000}-\x{10ffff}"
)
#: One comparison first: the class alone takes Java several times as long.
_COMPOSES = rf"[\u0300-\x{{10ffff}}&&[{_COMPOSING}]]"
_RUN = rf"[\x01-\x{{10ffff}}]?{_COMPOSES}+"


def nfc(x: Column) -> Column:
    """Composed text. Python gets only the runs that composition can change, with the character before each, parted by NUL, which composes with nothing;
    so its memory goes with these and not with the texts."""
    open_ = x.rlike(_COMPOSES)
    runs = F.split(_compose(F.when(open_, F.array_join(F.regexp_extract_all(x, F.lit(_RUN), F.lit(0)), "\0"))), "\0", -1)
    return F.when(open_, F.array_join(F.zip_with(F.split(x, _RUN, -1), runs, lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")).otherwise(x)


def fold_marks(x: Column) -> Column:
    """Quotation marks and dashes in one form, without Markdown emphasis, white space squeezed and stripped; for composed text."""
    plain = F.translate(x, EVIDENCE_MARKS + EVIDENCE_DROPPED, EVIDENCE_PLAIN)
    return strip(F.regexp_replace(plain, SPACE + "+", " "))


def normalize_evidence(x: Column) -> Column:
    return fold_marks(nfc(x))


def plain_evidence(text: str) -> str:
    """normalize_evidence() of one text, where an answer is looked at outside a DataFrame."""
    table = str.maketrans(EVIDENCE_MARKS, EVIDENCE_PLAIN, EVIDENCE_DROPPED)
    return " ".join(unicodedata.normalize("NFC", text).translate(table).split())


def without_topics(x: Column) -> Column:
    """Without the topic section, which reaches to the end; a text that has one ends in one newline."""
    cut = F.regexp_replace(x, rf"(?s)\n*{TOPICS_HEADING}:?{SPACE}*\n.*\z", "")
    return F.concat(F.regexp_replace(cut, rf"(?s){SPACE}+\z", ""), F.lit("\n"))


def with_topics(x: Column, names: Column) -> Column:
    """The text with one topic section at its end: a bullet for each name, or one that says there is none."""
    bullets = F.when(F.size(names) > 0, F.array_join(F.transform(names, lambda n: F.concat(F.lit("- "), n)), "\n")).otherwise(F.lit(f"- {NO_TOPICS}"))
    return F.concat(without_topics(x), F.lit(f"\n{TOPICS_HEADING}\n\n"), bullets, F.lit("\n"))


def topic_id(i: Column) -> Column:
    return F.format_string("topic_%02d", i)


def rounded_words(x: Column) -> Column:
    """As a prompt shows it: no decimals, halves to even."""
    return F.bround(x, 0).cast("long").cast("string")
