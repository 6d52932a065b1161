"""Headings of chapters, and what a web hit's text says of chapter and page, read token by token.

A line is taken apart from its left: a run of digits, blanks, a separator, the title. Each step is a string function on what
the last one left, so a rule can be read, and tested, by itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import closed, let, squeeze, strip

DIGITS = "0123456789"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\r\x0b\x0c"
# Separators between number and title, after the word chapter and without it; what else a title may hold
# beside letters and digits; characters at which a title in running text ends; lengths and numbers that count.
NAMED_SEPARATORS, BARE_SEPARATORS = ":.-–", "•·.-–"
TITLE_MARKS, TITLE_ENDS = " ,:&()/-'’", ("|", ".", ";", "\n")
MOST_CHAPTER, LEAST_TITLE, MOST_TITLE, MOST_SHOWN = 120, 3, 180, 120
# Words with which body text rather than a title begins.
BODY_WORDS = ("this", "these", "they", "there", "when", "however", "conversely", "more", "although", "because")
NO_CHAPTER = "章节定位不足"
SOURCES = ("source_snippet", "inferred_by_gpt", "unknown")


def lowered(text: Column) -> Column:
    """ASCII letters in lower case; the length stays."""
    return F.translate(text, UPPER, LOWER)


def _first(text: Column) -> Column:
    return F.left(text, F.lit(1))


def _any_of(char: Column, members: str) -> Column:
    return closed((char != "") & F.contains(F.lit(members), char))


def _wordlike(char: Column) -> Column:
    """Whether a character continues a word: a letter, digit or underscore of any script."""
    return closed(char.rlike(r"[\p{L}\p{N}_]"))


def leading_number(text: Column) -> Column:
    """The run of digits with which a text begins; '' if there is none."""
    return F.left(text, F.length(text) - F.length(F.ltrim(text, F.lit(DIGITS))))


def _after(text: Column, head: Column) -> Column:
    return F.substr(text, F.length(head) + 1)


def _past_separator(text: Column, separators: str) -> Column:
    """What follows blanks and at most one separator."""
    bare = F.ltrim(text, F.lit(BLANKS))
    return F.when(_any_of(_first(bare), separators), F.substr(bare, F.lit(2))).otherwise(bare)


def _without_page(line: Column) -> Column:
    """Up to four digits at the end of a squeezed line cut off."""
    return F.rtrim(F.regexp_replace(line, r"[0-9]{1,4}\z", ""))


def _before_next(line: Column) -> Column:
    """Words of a squeezed line up to a page number, of two to four digits, that another heading's letters follow."""
    return F.regexp_replace(line, r"(?s) [0-9]{2,4} [A-Za-z].*", "")


def names_chapter(line: Column) -> Column:
    """Whether a squeezed line begins with the word chapter and a whole number of up to three digits."""
    rest = F.substr(line, F.lit(9))
    number = leading_number(rest)
    return (lowered(F.left(line, F.lit(8))) == "chapter ") & F.length(number).between(1, 3) & ~_wordlike(_first(_after(rest, number)))


def clean_heading(line: Column) -> Column:
    """A line with white space squeezed and page numbers at its end, or between two headings, cut off."""
    return let(squeeze(F.coalesce(line, F.lit(""))), lambda x: _without_page(F.when(names_chapter(x), x).otherwise(_before_next(x))))


def _has_word(title: Column) -> Column:
    """Whether three ASCII letters stand side by side."""
    return F.contains(F.translate(title, UPPER + LOWER, "a" * 52), F.lit("aaa"))


def _plain_title(title: Column, begins: str) -> Column:
    """A title that begins as it must and holds nothing but letters, digits and marks."""
    rest = F.length(title) - 1
    return _any_of(_first(title), begins) & rest.between(LEAST_TITLE, MOST_TITLE) & (F.translate(title, UPPER + LOWER + DIGITS + TITLE_MARKS, "") == "")


def chapter_parts(line: Column) -> Column:
    """Struct of number and title of a chapter heading; NULL for numbers out of range, titles without a word, and body text.

    "Chapter 3: Airway", "3 - airway" and "3 Airway" are headings.
    """
    return parts_of_clean(clean_heading(line))


def parts_of_clean(heading: Column) -> Column:
    """``chapter_parts`` of a line that ``clean_heading`` has been through."""

    def of(x: Column) -> Column:
        named = lowered(F.left(x, F.lit(7))) == "chapter"
        rest = F.when(named, F.ltrim(F.substr(x, F.lit(8)), F.lit(BLANKS))).otherwise(x)
        number = F.when(named, F.left(leading_number(rest), F.lit(3))).otherwise(leading_number(rest))
        return let(F.struct(named.alias("named"), number.alias("number"), _after(rest, number).alias("tail")), titled)

    def titled(s: Column) -> Column:
        bare = F.ltrim(s["tail"], F.lit(BLANKS))
        separated = F.ltrim(_past_separator(s["tail"], BARE_SEPARATORS), F.lit(BLANKS))
        after_name = F.ltrim(_past_separator(s["tail"], NAMED_SEPARATORS), F.lit(BLANKS))
        title = F.when(s["named"], after_name)
        title = title.when(_any_of(_first(bare), BARE_SEPARATORS) & _plain_title(separated, UPPER + LOWER), separated)
        title = title.when((bare != s["tail"]) & _plain_title(bare, UPPER), bare)
        good = F.length(s["number"]).between(1, 3)
        return let(F.struct(F.when(good, s["number"]).cast("int").alias("number"), clean_heading(F.when(good, title)).alias("title")), checked)

    def checked(s: Column) -> Column:
        opening = lowered(F.element_at(F.split(s["title"], " "), 1))
        return F.when(closed(s["number"].between(1, MOST_CHAPTER)) & _has_word(s["title"]) & ~opening.isin(*BODY_WORDS), s)

    return let(heading, of)


def chapter_of_prefix(text: Column) -> Column:
    """The chapter named in a passage's prefix, as in [书籍: B, 章节: C]; '' if there is none.

    A prefix is what stands between square brackets, opens with the book, and has the chapter among its fields.
    """

    def field(inner: Column) -> Column:
        # the last field that is named so counts
        parts = F.split(F.regexp_replace(inner, "(?i)chapter", "章节"), "章节")
        value = F.ltrim(F.element_at(parts, -1), F.lit(BLANKS))
        ends = F.split(F.substr(value, F.lit(2)), r"[,|]")
        return F.when((F.size(parts) > 1) & _any_of(_first(value), ":："), strip(F.get(ends, F.lit(0)))).otherwise("")

    opened = F.slice(F.split(F.coalesce(text, F.lit("")), r"\["), F.lit(2), F.lit(1 << 30))
    inner = F.transform(opened, lambda x: F.substring_index(x, "]", 1))
    booked = F.filter(inner, lambda x: F.startswith(x, F.lit("书籍")) | (lowered(F.left(x, F.lit(4))) == "book"))
    return F.coalesce(F.get(F.filter(F.transform(booked, field), lambda v: v != ""), F.lit(0)), F.lit(""))


def shown_chapter(text: Column) -> Column:
    """Struct of number and title where a running text first says chapter, a number and a title; NULL if it doesn't."""

    def tail(s: Column, k: Column) -> Column:
        before = F.aggregate(F.slice(s["pieces"], F.lit(1), k), F.lit(0), lambda n, p: n + F.length(p) + len("chapter"))
        return F.ltrim(F.substr(s["text"], before + 1), F.lit(BLANKS))

    def parts(rest: Column) -> Column:
        number = F.left(leading_number(rest), F.lit(3))
        title = _past_separator(_after(rest, number), NAMED_SEPARATORS)
        # white space counts as part of a short title, not of one cut to its length
        ended = F.split(F.ltrim(title, F.lit(BLANKS)), "[" + "".join("\\" + e if e != "\n" else "\n" for e in TITLE_ENDS) + "]")
        shown = F.left(F.get(ended, F.lit(0)), F.lit(MOST_SHOWN))
        room = F.length(title) - F.length(F.ltrim(title, F.lit(BLANKS))) + F.length(shown)
        return F.struct(number.alias("number"), strip(shown).alias("title"), ((number != "") & (room >= LEAST_TITLE) & (strip(shown) != "")).alias("good"))

    def of(s: Column) -> Column:
        before = lambda k: F.get(s["pieces"], k - 1)
        begins = lambda k: (k < F.size(s["pieces"])) & ~_wordlike(F.right(before(k), F.lit(1))) & ((k == 1) | (before(k) != ""))
        places = F.filter(F.sequence(F.lit(1), F.size(s["pieces"])), begins)
        return F.get(F.filter(F.transform(places, lambda k: parts(tail(s, k))), lambda x: x["good"]), F.lit(0))

    return let(F.struct(text.alias("text"), F.split(lowered(text), "chapter").alias("pieces")), of)


def shown_page(text: Column) -> Column:
    """The number where a running text first says p, p. or page and one to four digits; NULL if it doesn't."""

    def number(rest: Column) -> Column:
        word = lowered(F.left(rest, F.lit(3))) == "age"
        rest = F.when(word, F.substr(rest, F.lit(4))).when(F.startswith(rest, F.lit(".")), F.substr(rest, F.lit(2))).otherwise(rest)
        rest = F.ltrim(_past_separator(rest, ".:"), F.lit(BLANKS))
        return let(rest, lambda x: F.when(F.length(leading_number(x)).between(1, 4) & ~_wordlike(_first(_after(x, leading_number(x)))), leading_number(x)))

    # each piece but the first follows a p that begins a word
    pieces = F.slice(F.split(text, r"(?<![\p{L}\p{N}_])[Pp]"), F.lit(2), F.lit(1 << 30))
    return F.get(F.filter(F.transform(pieces, number), lambda n: n.isNotNull()), F.lit(0))


def web_locator(hit: dict[str, Column], rank: Column, allow_inferred: bool = False) -> Column:
    """Struct of chapter, section, page, source, confidence and display locator of a web hit.

    ``hit`` has title, snippet and url, and may have what is stored with it: chapter, section, page, source, confidence.
    What is stored counts first, then what the hit's text shows; a locator that only a model has said counts, without
    its page and with a confidence of 0.6 at most, only if ``allow_inferred``. Missing texts are ''.
    """
    said = lambda n: F.coalesce(F.trim(hit[n]), F.lit("")) if n in hit else F.lit("")
    raw = lambda n: F.coalesce(hit[n], F.lit("")) if n in hit else F.lit("")
    text = F.concat(raw("title"), F.lit(" "), raw("snippet"), F.lit(" "), raw("url"))
    stored = F.struct(
        *[said(n).alias(n) for n in ("chapter", "section", "page")],
        F.when(said("source").isin(*SOURCES), said("source")).otherwise("").alias("source"),
        F.coalesce(hit["confidence"].cast("double") if "confidence" in hit else F.lit(0.0), F.lit(0.0)).alias("confidence"),
        F.struct(shown_chapter(text).alias("chapter"), shown_page(text).alias("page")).alias("shown"),
    )

    def merged(s: Column) -> Column:
        shown, page = s["shown"]["chapter"], s["shown"]["page"]
        by_chapter = (s["chapter"] == "") & shown.isNotNull()
        by_page = (s["page"] == "") & page.isNotNull()
        source = F.when(by_chapter | (by_page & s["source"].isin("", "unknown")), "source_snippet").otherwise(s["source"])
        by_model = F.concat(s["chapter"], s["section"], s["page"]) != ""
        return F.struct(
            F.when(by_chapter, F.concat(shown["number"], F.lit(" "), shown["title"])).otherwise(s["chapter"]).alias("chapter"),
            F.when(by_chapter & (s["section"] == ""), shown["title"]).otherwise(s["section"]).alias("section"),
            F.when(by_page, page).otherwise(s["page"]).alias("page"),
            F.when((source == "") & by_model, "inferred_by_gpt" if allow_inferred else "unknown").when(source == "", "unknown").otherwise(source).alias("source"),
            F.when(by_chapter | by_page, F.greatest(s["confidence"], F.lit(0.8))).otherwise(s["confidence"]).alias("confidence"),
        )

    def settled(s: Column) -> Column:
        source = s["source"] if allow_inferred else F.when(s["source"] == "inferred_by_gpt", "unknown").otherwise(s["source"])
        sure = F.when(source == "source_snippet", F.when(s["confidence"] <= 0, 0.8).otherwise(s["confidence"]))
        sure = sure.when(source == "inferred_by_gpt", F.least(F.when(s["confidence"] == 0, 0.5).otherwise(s["confidence"]), F.lit(0.6))).otherwise(0.0)
        known = lambda n: F.when(source != "unknown", s[n]).otherwise("")
        page = F.when(source == "source_snippet", s["page"]).otherwise("")
        return F.struct(known("chapter").alias("chapter"), known("section").alias("section"), page.alias("page"), source.alias("source"), sure.alias("confidence"))

    def displayed(s: Column) -> Column:
        name = F.coalesce(F.nullif(s["chapter"], F.lit("")), F.nullif(s["section"], F.lit("")), F.lit(NO_CHAPTER))
        shown = F.concat(F.lit("[WebM10#"), rank.cast("string"), F.lit(" | 术中相关章节: "), name, F.lit(" | p."), F.coalesce(F.nullif(s["page"], F.lit("")), F.lit("?")), F.lit("]"))
        return F.struct(*[s[n].alias(n) for n in ("chapter", "section", "page", "source", "confidence")], shown.alias("locator"))

    return let(let(let(stored, merged), settled), displayed)
