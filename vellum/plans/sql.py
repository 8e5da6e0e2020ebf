"""Pieces of DuckDB SQL for the oracles, written apart from the engine's expressions."""

from __future__ import annotations

from ..functions import text as X

WS = X.WS
SCRIPTS = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def words(x: str) -> str:
    return (
        f"flatten(list_transform(regexp_extract_all({x}, {q(X.RUN)}), lambda r: CASE WHEN regexp_matches(r, {q(SCRIPTS)}) "
        f"THEN regexp_extract_all(r, {q(X.CLUSTER)}) ELSE [r] END))"
    )


def split_lines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, {q(X.LINE_BREAK)})"
    return f"(CASE WHEN {parts}[-1] = '' THEN {parts}[:-2] ELSE {parts} END)"


def sentences(x: str) -> str:
    wide = f"regexp_replace({x}, {q(f'([{X.terminal_class()}][{X.CLOSERS}]*)')}, {q(chr(92) + '1' + chr(10))}, 'g')"
    closers = f"([.!?][{X.CLOSERS}]*)({WS}|\\z)"
    plain = f"regexp_replace({wide}, {q(closers)}, {q(chr(92) + '1' + chr(10))}, 'g')"
    return f"list_filter(list_transform(string_split({plain}, chr(10)), lambda s: {strip('s')}), lambda s: s <> '')"


def simplify(x: str) -> str:
    """Without the removal of combining marks."""
    low = f"regexp_replace(lower({x}), {q(X.NUMBER)}, '0', 'g')"
    bare = f"regexp_replace({low}, {q(X.punctuation_class())}, ' ', 'g')"
    return strip(f"regexp_replace({strip(bare)}, {q(WS + '+')}, ' ', 'g')")


def total(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: length(x))), 0)"


def dup_n(items: str) -> str:
    return f"(len({items}) - len(list_distinct({items})))"


def dup_c(items: str) -> str:
    return f"({total(items)} - {total(f'list_distinct({items})')})"


def share(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN round(({a})::DOUBLE / ({b}), 6) ELSE 0.0 END)"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def sha1_64(x: str) -> str:
    """The first eight bytes of SHA-1, little endian, as a signed number."""
    h = f"sha1({x})"
    swapped = " || ".join(f"substr({h}, {i}, 2)" for i in range(15, 0, -2))
    u = f"(('0x' || {swapped})::UBIGINT)::HUGEINT"
    return f"(CASE WHEN {u} >= 9223372036854775808 THEN {u} - 18446744073709551616 ELSE {u} END)::BIGINT"


def sha1_64_unsigned(x: str) -> str:
    h = f"sha1({x})"
    swapped = " || ".join(f"substr({h}, {i}, 2)" for i in range(15, 0, -2))
    return f"('0x' || {swapped})::UBIGINT::HUGEINT"


def ratio_of(items: str, test: str) -> str:
    return share(f"len(list_filter({items}, lambda x: {test}))", f"len({items})")


DOCS = "docs AS (SELECT * FROM documents WHERE length(text) > 0)"
