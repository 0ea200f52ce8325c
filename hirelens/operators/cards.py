"""Listing cards: text lines -> posting fields.

A card is one short text; its lines are an array and every rule is an expression
over it, so a card is parsed in place, in one projection, with no exchange. A rule
usually takes the first line that qualifies; its 1-based position is kept because
the description is made of the lines no rule has used.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.links import absolute_link, id_from_link
from hirelens.functions.text import (
    contains_any, first_listed, is_listed, let, present, strip, text_of,
)

Test = Callable[[Column], Column]


def card_lines(text: Column | str) -> Column:
    """Stripped, non-blank lines."""
    lines = F.transform(F.split(text_of(text), "\n"), strip)
    return F.filter(lines, lambda line: line != "")


# Spark may inline a column that is used once, also into a lambda, where it would be
# computed again for every line. Whatever a line test needs is therefore bound by let().


def _first(lines: Column, test: Test) -> Column:
    """The first line that passes, null when none does."""
    return F.get(F.filter(lines, test), 0)


def _any_of(words: Column) -> Test:
    """Test for any word of an array."""
    return lambda line: F.exists(words, lambda w: F.contains(line, w))


def _first_with(lines: Column, text: Column, words: list[str], also: Test | None = None) -> Column:
    """The first line with one of the words (that passes another test).

    Lines are searched only for the words that the card contains at all.
    """

    def find(there: Column) -> Column:
        has = _any_of(there)
        return _first(lines, (lambda line: has(line) & also(line)) if also else has)

    return let(present(text, words), find)


def _position(lines: Column, line: Column) -> Column:
    """1-based place of a rule's line, 0 for null.

    A rule decides by the text of a line alone, so the first line that passes is the
    first one with that text.
    """
    return F.coalesce(F.array_position(lines, line), F.lit(0))


def _last_position(lines: Column, line: Column) -> Column:
    back = F.array_position(F.reverse(lines), line)
    return F.when(back > 0, F.size(lines) + 1 - back).otherwise(F.lit(0).cast("bigint"))


def _is_headcount(line: Column) -> Column:
    return line.contains(V.CARD_PEOPLE) & contains_any(line, V.CARD_PEOPLE_RANGE)


def _is_candidate(title: Column, refused_parts: Column) -> Test:
    """Whether a line may be a company name."""

    def test(line: Column) -> Column:
        refused = (
            is_listed(
                line,
                V.CARD_NOT_COMPANY_LINES + V.CARD_NOT_COMPANY_CITIES + V.CARD_NOT_COMPANY_INDUSTRIES,
            )
            | _any_of(refused_parts)(line)
            | _is_headcount(line)
            | (line == title)
        )
        return ~refused & F.length(line).between(2, 40)

    return test


def _all_words(text: Column, lines: Column, words: list[str]) -> Column:
    """Words found anywhere, as structs (at = first line, nth = list order, word), sorted.

    Sorting by first line and then by list order is the order in which a line-by-line
    search meets them. Only words that the whole text contains are looked up per line.
    """
    # a constant array of structs, folded to one literal when the query is planned
    entries = ", ".join(
        f"named_struct('nth', {i}, 'word', '{w}', 'low', '{w.lower()}')" for i, w in enumerate(words)
    )
    listed = F.expr(f"array({entries})")

    def find(t: Column) -> Column:
        return F.filter(listed, lambda s: F.contains(t, s["low"]))

    def place(own: Column) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            F.array_position(
                F.transform(own, lambda line: F.contains(line, s["low"])), F.lit(True)
            ).alias("at"),
            s["nth"].alias("nth"),
            s["word"].alias("word"),
        )

    return F.array_sort(let(lines, lambda own: F.transform(let(text, find), place(own))))


def _joined(hits: Column) -> Column:
    """The words of ``_all_words`` joined by commas, null when there are none."""
    return F.when(F.size(hits) > 0, F.array_join(F.transform(hits, lambda h: h["word"]), ","))


def parse_cards(
    cards: DataFrame, base_url: str, text: str = "card_text", href: str = "href",
    degree_hint: str | None = None,
) -> DataFrame:
    """Add the posting fields of a card.

    ``degree_hint`` names an optional column with the text of the card's education
    element, which is preferred over the lines.
    """
    L, text_, title = F.col("_lines"), F.col("_text"), F.col("job_name")
    blank, none = F.lit(""), F.lit(None).cast("string")

    def unspaced(t: Column) -> Column:
        return F.replace(t, F.lit(" "), blank)

    def banned(line: Column) -> Column:
        return contains_any(line, V.CARD_TITLE_BANNED)

    df = (
        cards.withColumn("_lines", card_lines(text))
        .withColumn("_text", F.array_join("_lines", "\n"))
        .withColumn("_lower", F.lower("_text"))
    )

    # A line with a job word among the first ten, else a long enough first line
    head = F.get(L, 0)
    df = df.withColumn(
        "job_name",
        F.coalesce(
            _first_with(
                F.slice(L, 1, 10), text_, V.CARD_TITLE_WORDS,
                lambda line: (F.length(line) >= 4) & ~banned(line),
            ),
            F.when(F.length(head) >= 4, head),
            blank,
        ),
    )

    hint = first_listed(F.col(degree_hint), V.CARD_DEGREES) if degree_hint else none
    df = df.withColumns(
        {
            "_degree_hint": hint,
            "_type_in_title": first_listed(title, V.CARD_JOB_TYPES),
            "_candidates": let(
                title,
                lambda t: let(
                    present(text_, V.CARD_NOT_COMPANY_PARTS),
                    lambda parts: F.filter(L, _is_candidate(t, parts)),
                ),
            ),
        }
    )

    def matches(mark: str, pattern: str) -> Column:
        """First line with a pattern; cards without its mark are not searched."""
        return F.when(text_.contains(mark), _first(L, lambda line: line.rlike(pattern)))

    df = df.withColumns(
        {
            "_named": _first_with(F.reverse("_candidates"), text_, V.CARD_COMPANY_WORDS),
            "_bottom": F.get(F.reverse("_candidates"), 0),
            "_l_pay": let(
                present(unspaced(text_), V.CARD_PAY_PARTS),
                lambda there: _first(L, lambda line: let(unspaced(line), _any_of(there))),
            ),
            "_l_city": _first_with(L, text_, V.CARD_CITIES),
            "_l_degree": F.when(
                F.col("_degree_hint").isNull(), _first_with(L, text_, V.CARD_DEGREES)
            ),
            "_l_type": F.when(
                F.col("_type_in_title").isNull(), _first_with(L, text_, V.CARD_JOB_TYPES)
            ),
            "_l_industry": _first_with(L, text_, V.CARD_INDUSTRIES),
            "_l_people": F.when(text_.contains(V.CARD_PEOPLE), _first(L, _is_headcount)),
            "_l_nature": _first_with(L, text_, V.CARD_NATURES),
            "_l_year": let(
                present(text_, V.CARD_YEAR_WORDS),
                lambda there: _first(
                    L, lambda line: _any_of(there)(line) | line.rlike(V.RE_CARD_YEAR)
                ),
            ),
            "_l_days": matches("周", V.RE_CARD_DAYS),
            "_l_term": matches("个月", V.RE_CARD_TERM),
            "_l_conversion": _first_with(L, text_, V.CARD_CONVERSION_YES + V.CARD_CONVERSION_NO),
            "_benefits": _all_words(text_, L, V.CARD_BENEFITS),
            "_skills": _all_words(F.col("_lower"), F.split("_lower", "\n"), V.CARD_SKILLS),
        }
    )

    found = [
        "_l_pay", "_l_city", "_l_degree", "_l_type", "_l_industry", "_l_people", "_l_nature",
        "_l_year", "_l_days", "_l_term", "_l_conversion",
    ]
    # The title is the first line with its text; the company scan ran from the bottom and
    # has used the bottommost candidate as well as the one with a company word.
    used = F.concat(
        F.array(
            F.when(title != "", _position(L, title)).otherwise(F.lit(0).cast("bigint")),
            _last_position(L, F.col("_named")),
            _last_position(L, F.col("_bottom")),
            *[_position(L, F.col(c)) for c in found],
        ),
        F.transform("_benefits", lambda h: h["at"]),
        F.transform("_skills", lambda h: h["at"]),
    )
    term = text_of("_l_term")
    months = F.concat(F.regexp_extract(term, V.RE_CARD_TERM, 2), F.lit("个月"))
    bounded = (F.regexp_extract(term, V.RE_CARD_TERM, 1) != "") | (
        F.regexp_extract(term, V.RE_CARD_TERM, 3) != ""
    )

    def word_in(line: str, listed: list[str]) -> Column:
        return F.when(F.col(line).isNotNull(), first_listed(F.col(line), listed))

    df = df.withColumns(
        {
            "_used": used,
            "company_name": F.coalesce(
                F.when(F.col("_named").isNotNull(), strip(F.replace("_named", F.lit(V.CARD_COMPANY_SUFFIX), blank))),
                F.col("_bottom"),
                blank,
            ),
            "salary": text_of("_l_pay"),
            "city": F.coalesce(word_in("_l_city", V.CARD_CITIES), blank),
            "education": F.coalesce("_degree_hint", word_in("_l_degree", V.CARD_DEGREES), blank),
            "job_type": F.coalesce("_type_in_title", word_in("_l_type", V.CARD_JOB_TYPES), blank),
            "company_type": F.coalesce(word_in("_l_industry", V.CARD_INDUSTRIES), blank),
            "recruit_count": text_of("_l_people"),
            "company_nature": F.coalesce(
                word_in("_l_nature", V.CARD_NATURES), first_listed(title, V.CARD_NATURES), blank
            ),
            "graduate_year": F.coalesce(
                word_in("_l_year", V.CARD_YEAR_WORDS),
                F.regexp_extract("_l_year", V.RE_CARD_YEAR, 0),
                blank,
            ),
            "work_days_per_week": text_of(F.regexp_extract("_l_days", V.RE_CARD_DAYS, 1)),
            "intern_duration": F.when(term == "", blank)
            .when(bounded, F.concat(F.lit("≥"), months))
            .otherwise(months),
            "has_conversion": F.when(F.col("_l_conversion").isNull(), blank)
            .when(contains_any(F.col("_l_conversion"), V.CARD_CONVERSION_YES), F.lit(V.YES))
            .otherwise(F.lit(V.NO)),
            "benefit_tags": _joined(F.col("_benefits")),
            "skill_tags": _joined(F.col("_skills")),
            "job_link": F.coalesce(absolute_link(href, base_url), blank),
        }
    )
    free = let(
        F.col("_used"),
        lambda taken: let(
            present(text_, V.CARD_PROMO_PARTS),
            lambda promo: F.filter(
                L,
                lambda line, i: ~F.array_contains(taken, (i + 1).cast("bigint"))
                & ~_any_of(promo)(line),
            ),
        ),
    )
    df = df.withColumns(
        {"job_desc": F.array_join(free, "\n"), "job_id": id_from_link("job_link")}
    )
    parsed = df.drop(*[c for c in df.columns if c.startswith("_")])
    # Counting the cards also keeps a later filter on a field above the parse; pushed
    # below, it would repeat the parse for every field it reads.
    return parsed.observe(f"cards-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("cards"))


def rejection(site: str) -> Column:
    """Why a parsed card is not a posting: the first failing rule, null when it is one."""
    name, company, link = strip("job_name"), strip("company_name"), strip("job_link")
    return (
        F.when(F.length(name) < 3, "title_too_short")
        .when(~link.contains(site), "bad_link")
        .when(contains_any(name, V.CARD_INVALID_TITLE_PARTS), "invalid_word")
        .when(is_listed(name, V.CARD_INVALID_TITLES), "title_is_place_or_degree")
        .when(F.length(name) < 4, "title_too_short")
        .when(F.length(company) < 2, "bad_company")
        .when(company.isin(V.CARD_PAY_COMPANIES), "company_is_pay")
    )


def valid_cards(parsed: DataFrame, site: str) -> DataFrame:
    """P7."""
    return parsed.where(rejection(site).isNull())


def rejected_counts(parsed: DataFrame, site: str) -> DataFrame:
    """Rejected cards per reason."""
    return (
        parsed.select(rejection(site).alias("reason")).groupBy("reason")
        .agg(F.count("reason").alias("card_count")).where("card_count > 0")
    )
