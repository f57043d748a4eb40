"""Person names: tokens, matching keys, matchers and match scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.arrays import distinct_ignore_case, non_null
from citeloom.functions.bind import bind
from citeloom.functions.text import ws

# Words that mark a heading as not being a person's name.
NAME_STOPWORDS = [
    "team",
    "faculty",
    "students",
    "postdocs",
    "news",
    "events",
    "contact",
    "opportunities",
    "institute",
    "research",
    "materials",
]
NAME_TOKEN = r"^[A-Z][A-Za-z'`.-]*$"


def tokens(c: Column) -> Column:
    """Lower-case ASCII-letter tokens, in order."""
    return F.filter(
        F.split(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z ]", " ")), " +"), lambda t: t != ""
    )


def letters_key(c: Column) -> Column:
    """Lower-case ASCII letters only."""
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def first(toks: Column) -> Column:
    return F.get(toks, F.lit(0))


def last(toks: Column) -> Column:
    return F.get(toks, F.size(toks) - 1)


def initial(token: Column) -> Column:
    return F.substring(token, 1, 1)


def flip_comma_name(c: Column) -> Column:
    """``Last, First`` to ``First Last``; names without a comma are only cleaned."""
    return bind(
        ws(c),
        lambda n: F.when(
            n.contains(","), ws(F.concat_ws(" ", F.regexp_extract(n, r"^[^,]*,(.*)$", 1), F.substring_index(n, ",", 1)))
        ).otherwise(n),
    )


def is_probable_person(c: Column, extra_stopwords: list[str] | None = None) -> Column:
    """Length 5-80, no heading word, two to six capitalised tokens."""
    words = NAME_STOPWORDS + [w.lower() for w in extra_stopwords or []]
    return F.coalesce(bind(ws(c), lambda clean: _person_test(clean, words)), F.lit(False))


def _person_test(clean: Column, words: list[str]) -> Column:
    parts = F.split(F.replace(clean, F.lit("’"), F.lit("'")), " ")
    heading = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(clean), w))
    token_ok = F.forall(
        parts,
        lambda t: (t.endswith(".") & (F.length(t) == 2) & F.regexp_like(t, F.lit(r"^\p{Lu}")))
        | F.regexp_like(t, F.lit(NAME_TOKEN)),
    )
    return F.length(clean).between(5, 80) & F.size(parts).between(2, 6) & token_ok & ~heading


# --- matching -------------------------------------------------------------------------------------------------


def surname_initial_keys(toks: Column) -> Column:
    """Keys under which an author can meet a member: last name and first initial, in both name orders.

    Two names match by this rule exactly if one of the author's keys equals the member's own
    ``surname_initial_key``: an equal first name implies an equal initial.
    """
    def keys(t: Column) -> Column:
        straight = F.concat_ws("|", last(t), initial(first(t)))
        swapped = F.concat_ws("|", first(t), initial(last(t)))
        return F.when(F.size(t) >= 2, F.array_distinct(F.array(straight, swapped))).otherwise(
            F.expr("cast(array() as array<string>)")
        )

    return bind(toks, keys)


def surname_initial_key(toks: Column) -> Column:
    """The member side of the rule above; NULL for names of fewer than two tokens."""
    return bind(toks, lambda t: F.when(F.size(t) >= 2, F.concat_ws("|", last(t), initial(first(t)))))


def surname_initial_match(member_toks: Column, author_toks: Column) -> Column:
    """The same rule as a predicate, for rows that already hold both names."""
    return F.coalesce(
        F.array_contains(surname_initial_keys(author_toks), surname_initial_key(member_toks)), F.lit(False)
    )


def any_author_matches(key: Column, authors: Column) -> Column:
    """True if there are no authors, or one of them matches the member with this ``surname_initial_key``."""
    return (F.size(authors) == 0) | F.exists(
        authors, lambda a: F.coalesce(F.array_contains(surname_initial_keys(tokens(a)), key), F.lit(False))
    )


def given_names_match(member_given: Column, author_given: Column) -> Column:
    """Full given names equal, or initials of one equal to the other in compact form."""
    def test(m: Column, a: Column) -> Column:
        m_init = F.array_join(F.transform(member_given, initial), "")
        a_init = F.array_join(F.transform(author_given, initial), "")
        either = (
            (m == a)
            | (a == m_init)
            | ((m == a_init) & (F.length(m) <= 3))
            | ((F.length(a) == 1) & (a == initial(m)))
            | ((F.length(m) == 1) & (m == initial(a)))
        )
        return (m != "") & (a != "") & either

    return bind(
        F.array_join(member_given, ""), lambda m: bind(F.array_join(author_given, ""), lambda a: test(m, a))
    )


def full_given_keys(toks: Column) -> Column:
    """Surname and first letter of the given names: with the surname at the end, then at the front."""
    def keys(t: Column) -> Column:
        letter = lambda start: F.substring(F.array_join(F.slice(t, F.lit(start), F.size(t) - 1), ""), 1, 1)
        return F.array_distinct(F.array(F.concat_ws("|", last(t), letter(1)), F.concat_ws("|", first(t), letter(2))))

    return bind(toks, keys)


def full_given_match(member_toks: Column, author_toks: Column) -> Column:
    """Surname equal (at the end, else at the front) and given names compatible."""
    def test(m: Column, a: Column) -> Column:
        given = F.slice(m, F.lit(1), F.size(m) - 1)
        rest = (
            F.when(last(a) == last(m), F.slice(a, F.lit(1), F.size(a) - 1))
            .when(first(a) == last(m), F.slice(a, F.lit(2), F.size(a) - 1))
        )
        return (
            F.when((F.size(m) < 2) | (F.size(a) < 2), F.lit(False))
            .otherwise(F.coalesce(given_names_match(given, rest), F.lit(False)))
        )

    return F.coalesce(bind(member_toks, lambda m: bind(author_toks, lambda a: test(m, a))), F.lit(False))


def any_author_full_given(member_toks: Column, authors: Column) -> Column:
    """True if there are no authors, or one of them matches the member with these tokens."""
    return (F.size(authors) == 0) | F.exists(authors, lambda a: full_given_match(member_toks, tokens(a)))


# --- scores ---------------------------------------------------------------------------------------------------


def _with_tokens(target: Column, candidate: Column, fn) -> Column:
    return bind(tokens(target), lambda t: bind(tokens(candidate), lambda c: fn(t, c)))


def _overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def score_dblp(target: Column, candidate: Column, has_notes: Column) -> Column:
    """Surname +25/-40, given name 30/12/-12, 8 per shared token, 100 for equality, 2 for curated notes."""
    def score(t: Column, c: Column) -> Column:
        both_first = first(t).isNotNull() & first(c).isNotNull()
        return (
            F.when(last(t) == last(c), 25.0).otherwise(-40.0)
            + F.when(
                both_first,
                F.when(first(t) == first(c), 30.0).when(initial(first(t)) == initial(first(c)), 12.0).otherwise(-12.0),
            ).otherwise(0.0)
            + _overlap(t, c) * 8.0
            + F.when(letters_key(target) == letters_key(candidate), 100.0).otherwise(0.0)
            + F.when(has_notes, 2.0).otherwise(0.0)
        )

    blank = F.coalesce(ws(candidate), F.lit("")) == ""
    return F.when(blank, F.lit(float("-inf"))).otherwise(_with_tokens(target, candidate, score))


def score_openalex(target: Column, candidate: Column) -> Column:
    """Surname 20/-30, given name 20/8/-8, 6 per shared token, 60 for equality."""
    def score(t: Column, c: Column) -> Column:
        points = (
            F.when(last(t) == last(c), 20.0).otherwise(-30.0)
            + F.when(first(t) == first(c), 20.0).when(initial(first(t)) == initial(first(c)), 8.0).otherwise(-8.0)
            + _overlap(t, c) * 6.0
            + F.when(letters_key(target) == letters_key(candidate), 60.0).otherwise(0.0)
        )
        return F.when((F.size(t) == 0) | (F.size(c) == 0), F.lit(-100.0)).otherwise(points)

    return _with_tokens(target, candidate, score)


def score_semantic_scholar(target: Column, candidate: Column) -> Column:
    """Surname 30/10/-30, given name 30/12/-12, 6 per shared token."""
    def score(t: Column, c: Column) -> Column:
        points = (
            F.when(last(t) == last(c), 30.0).when(F.array_contains(c, last(t)), 10.0).otherwise(-30.0)
            + F.when(first(t) == first(c), 30.0).when(initial(first(t)) == initial(first(c)), 12.0).otherwise(-12.0)
            + _overlap(t, c) * 6.0
        )
        return F.when((F.size(t) == 0) | (F.size(c) == 0), F.lit(-100.0)).otherwise(points)

    return _with_tokens(target, candidate, score)


# --- variants -------------------------------------------------------------------------------------------------


def name_variants(c: Column) -> Column:
    """Spellings under which a person may be listed: full, tokens, first and last, initials, with middle names."""
    return bind(tokens(c), lambda t: _variants(c, t))


def _variants(c: Column, t: Column) -> Column:
    inits = F.transform(F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))), initial)
    middle = F.slice(t, F.lit(2), F.greatest(F.size(t) - 2, F.lit(0)))
    has_inits = F.size(inits) > 0
    variants = F.array(
        c,
        F.array_join(t, " "),
        F.concat_ws(" ", first(t), last(t)),
        F.when(has_inits, F.concat_ws(" ", F.array_join(inits, " "), last(t))),
        F.when(has_inits, F.concat_ws(" ", first(inits), last(t))),
        F.when(F.size(middle) > 0, F.concat_ws(" ", first(t), F.array_join(middle, " "), last(t))),
    )
    return F.when(F.size(t) == 0, F.array(c)).otherwise(distinct_ignore_case(non_null(variants)))


def arxiv_author_query(c: Column) -> Column:
    """Author search phrase: full name, first and last name, initial and last name."""
    clean, t = ws(F.coalesce(c, F.lit(""))), tokens(c)
    variants = distinct_ignore_case(
        non_null(
            F.array(
                clean,
                F.when(F.size(t) >= 2, F.concat_ws(" ", first(t), last(t))),
                F.when(F.size(t) >= 2, F.concat_ws(" ", initial(first(t)), last(t))),
            )
        )
    )
    phrases = F.transform(variants, lambda v: F.concat(F.lit('au:"'), v, F.lit('"')))
    return F.when(clean == "", F.lit('au:""')).otherwise(F.array_join(phrases, " OR "))


def pubmed_author_query(c: Column, min_year: int) -> Column:
    """Author and date search phrase; names of one token are quoted only."""
    t = tokens(c)
    long_form = F.concat(
        F.lit('("'), last(t), F.lit(" "), initial(first(t)), F.lit('"[Author] OR "'), c,
        F.lit(f'"[Author]) AND ("{min_year}/01/01"[Date - Publication] : "3000"[Date - Publication])'),
    )
    return F.when(F.size(t) < 2, F.concat(F.lit('"'), c, F.lit('"[Author]'))).otherwise(long_form)
