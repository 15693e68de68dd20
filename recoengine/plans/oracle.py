"""The role views of :mod:`recoengine.plans.roles` as DuckDB SQL.

``with_roles(body, "interactions", ...)`` prefixes a query with the CTEs it
names (and the ones they depend on).  Tables are the driver's pre-registered
views.
"""

from __future__ import annotations

from recoengine.plans.roles import (
    FIXTURE_BOOSTERS_DOWN,
    FIXTURE_BOOSTERS_UP,
    FIXTURE_LEXICON,
    FIXTURE_NEGATORS,
    FIXTURE_PHRASES,
    PHRASE_BOOSTERS_DOWN,
    PHRASE_BOOSTERS_UP,
    PHRASE_LEXICON,
    PHRASE_NEGATORS,
)


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_LEX_ROWS = ", ".join(f"('{t}', CAST({v} AS DOUBLE))" for t, v in FIXTURE_LEXICON)
_BOOST_ROWS = ", ".join(
    [f"('{w}', CAST(0.293 AS DOUBLE))" for w in FIXTURE_BOOSTERS_UP]
    + [f"('{w}', CAST(-0.293 AS DOUBLE))" for w in FIXTURE_BOOSTERS_DOWN]
)

_PHRASE_LEX_ROWS = ", ".join(f"('{t}', CAST({v} AS DOUBLE))" for t, v in FIXTURE_LEXICON + PHRASE_LEXICON)
_PHRASE_BOOST_ROWS = ", ".join(
    [f"('{w}', CAST(0.293 AS DOUBLE))" for w in FIXTURE_BOOSTERS_UP + PHRASE_BOOSTERS_UP]
    + [f"('{w}', CAST(-0.293 AS DOUBLE))" for w in FIXTURE_BOOSTERS_DOWN + PHRASE_BOOSTERS_DOWN]
)

ROLE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "interactions": ((), """
        SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
               'part ' || CAST(l.l_partkey AS VARCHAR) AS book_title,
               CAST(1 + FLOOR((l.l_quantity - 1) / 10) AS FLOAT) AS rating,
               o.o_orderdate AS review_time,
               l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice,
               l.l_partkey, l.l_quantity
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "part_meta": ((), """
        SELECT 'part ' || CAST(p_partkey AS VARCHAR) AS book_title,
               p_brand AS author, p_type AS categories
        FROM part"""),
    "part_descriptions": ((), """
        SELECT 'part ' || CAST(p_partkey AS VARCHAR) AS book_title,
               CASE WHEN p_partkey % 5 = 0 THEN NULL
                    WHEN p_partkey % 5 = 1 THEN p_name
                    ELSE concat_ws(' ', p_name, 'is a', lower(p_type), 'part of size',
                                   CAST(p_size AS VARCHAR), 'sold under', p_brand,
                                   'for a retail price of', CAST(p_retailprice AS VARCHAR))
               END AS description
        FROM part"""),
    "rated_books": (("interactions", "part_descriptions"), """
        SELECT i.book_title, i.rating, d.description
        FROM interactions i LEFT JOIN part_descriptions d ON i.book_title = d.book_title"""),
    "reviews_raw": ((), """
        SELECT CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS "User_id",
               CASE WHEN l.l_partkey % 97 = 0 THEN 'N/A'
                    WHEN l.l_partkey % 89 = 0 THEN ''
                    WHEN l.l_partkey % 3 = 0 THEN 'Part ' || CAST(l.l_partkey AS VARCHAR)
                    WHEN l.l_partkey % 3 = 1 THEN 'PART ' || CAST(l.l_partkey AS VARCHAR) || '!'
                    ELSE 'part, ' || CAST(l.l_partkey AS VARCHAR) END AS "Title",
               'Customer ' || CAST(o.o_custkey AS VARCHAR) AS "profileName",
               CASE WHEN l.l_quantity > 48 THEN 'abc'
                    WHEN l.l_quantity < 2 THEN '0'
                    WHEN l.l_quantity = 2 THEN 'NaN'
                    ELSE CAST(CAST(1 + FLOOR((l.l_quantity - 1) / 10) AS BIGINT) AS VARCHAR) END AS "review/score",
               d.text AS "review/text",
               'Order ' || CAST(l.l_orderkey AS VARCHAR) AS "review/summary",
               CASE WHEN l.l_linenumber = 3 AND l.l_partkey % 2 = 0 THEN NULL
                    ELSE CAST(date_diff('day', DATE '1970-01-01', CAST(o.o_orderdate AS DATE)) AS BIGINT) END AS "review/time",
               CAST(l.l_linenumber AS VARCHAR) || '/7' AS "review/helpfulness"
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             LEFT JOIN documents d ON l.l_partkey = d.doc_id"""),
    "books_raw": ((), """
        SELECT CASE WHEN p_partkey % 3 = 0 THEN 'Part ' || CAST(p_partkey AS VARCHAR) || '.'
                    WHEN p_partkey % 3 = 1 THEN 'part ' || CAST(p_partkey AS VARCHAR)
                    ELSE 'PART: ' || CAST(p_partkey AS VARCHAR) END AS "Title",
               CASE WHEN p_partkey % 10 = 0 THEN 'N/A'
                    WHEN p_partkey % 10 = 1 THEN ''
                    WHEN p_partkey % 10 = 2 THEN NULL
                    ELSE concat_ws(' ', p_name, 'is a', lower(p_type), 'part of size', CAST(p_size AS VARCHAR)) END AS description,
               CASE WHEN p_partkey % 10 = 0 THEN 'N/A'
                    WHEN p_partkey % 11 = 0 THEN '[''' || p_brand || ' Review Team'']'
                    WHEN p_partkey % 13 = 0 THEN '[''' || repeat(p_brand, 20) || ''']'
                    ELSE '[''' || p_brand || ''']' END AS authors,
               CASE WHEN p_partkey % 17 = 0 THEN 'null' ELSE '[''' || p_type || ''']' END AS categories,
               'Pub ' || p_brand AS publisher,
               CAST(1990 + p_size % 30 AS VARCHAR) AS "publishedDate",
               p_retailprice AS "ratingsCount"
        FROM part
        UNION ALL
        SELECT upper(CASE WHEN p_partkey % 3 = 0 THEN 'Part ' || CAST(p_partkey AS VARCHAR) || '.'
                          WHEN p_partkey % 3 = 1 THEN 'part ' || CAST(p_partkey AS VARCHAR)
                          ELSE 'PART: ' || CAST(p_partkey AS VARCHAR) END),
               concat_ws(' ', 'Second edition of', p_name),
               '[''' || p_brand || ''', ''Editor'']',
               '[''' || p_type || ''']',
               'Reprint House', '2001', p_retailprice
        FROM part WHERE p_size > 45"""),
    "item_texts_src": ((), """
        SELECT 'doc ' || CAST(doc_id AS VARCHAR) AS book_title, text AS description FROM documents"""),
    "asked_titles": ((), """
        SELECT CASE WHEN doc_id % 100 = 0 THEN 'DOC ' ELSE 'doc ' END || CAST(doc_id AS VARCHAR)
               || CASE WHEN doc_id % 350 = 50 THEN ' volume two' ELSE '' END AS query
        FROM documents WHERE doc_id % 50 = 0"""),
    "catalog": ((), """
        SELECT CASE WHEN doc_id % 2 = 1 THEN 'Part ' || CAST(doc_id AS VARCHAR)
                    ELSE 'part ' || CAST(doc_id AS VARCHAR) || ' collector edition' END AS title,
               text AS description
        FROM documents"""),
    "worded_books": ((), """
        SELECT array_to_string(string_split(text, ' ')[1:8], ' ') AS book_title, CAST(NULL AS VARCHAR) AS description FROM documents"""),
    "worded_catalog": ((), """
        SELECT array_to_string(string_split(text, ' ')[3:9], ' ') AS title, text AS description FROM documents"""),
    "review_texts": ((), """
        SELECT doc_id AS id, CASE WHEN doc_id % 50 = 7 THEN NULL ELSE text END AS review_text FROM documents"""),
    "event_interactions": ((), """
        SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS book_title, value AS label_rating FROM events"""),
    "cf_ratings": (("interactions", "part_meta"), """
        SELECT d.user_id, d.book_title, d.rating AS label_rating, m.author, m.categories, d.review_time
        FROM (SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, book_title ORDER BY review_time DESC NULLS LAST,
                       rating DESC NULLS LAST, l_orderkey ASC NULLS LAST, l_linenumber ASC NULLS LAST,
                       l_suppkey ASC NULLS LAST, l_extendedprice ASC NULLS LAST) AS rn
                FROM interactions WHERE rating IS NOT NULL AND rating >= 1 AND rating <= 5) WHERE rn = 1) d
        LEFT JOIN part_meta m ON d.book_title = m.book_title"""),
    "seen": (("interactions", "part_meta"), """
        SELECT i.user_id, i.book_title, i.rating AS label_rating, m.author, m.categories
        FROM interactions i LEFT JOIN part_meta m ON i.book_title = m.book_title
        WHERE i.review_time < TIMESTAMP '1999-01-01 00:00:00'"""),
    "cands": (("interactions",), """
        SELECT user_id, book_title, sum(l_quantity) / 50.0 AS cf_score FROM interactions
        WHERE NOT (review_time < TIMESTAMP '1999-01-01 00:00:00') GROUP BY user_id, book_title"""),
    "lexicon": ((), f"SELECT * FROM (VALUES {_LEX_ROWS}) t(token, valence)"),
    "boosters": ((), f"SELECT * FROM (VALUES {_BOOST_ROWS}) t(tok, b)"),
    "phrase_lexicon": ((), f"SELECT * FROM (VALUES {_PHRASE_LEX_ROWS}) t(token, valence)"),
    "phrase_boosters": ((), f"SELECT * FROM (VALUES {_PHRASE_BOOST_ROWS}) t(tok, b)"),
    "phrases": ((), "SELECT phrase, len(string_split(phrase, ' ')) AS len FROM (VALUES " + ", ".join(f"('{p}')" for p in FIXTURE_PHRASES) + ") t(phrase)"),
}

NEGATOR_LIST_SQL = _list(FIXTURE_NEGATORS)
PHRASE_NEGATOR_LIST_SQL = _list(FIXTURE_NEGATORS + PHRASE_NEGATORS)


def with_roles(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs for ``names`` and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in ROLE_SQL[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({ROLE_SQL[n][1]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
