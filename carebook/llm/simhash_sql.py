"""DuckDB SQL for the SimHash query: XXH64 in 64-bit steps, fingerprints, and the closure of the links.

It compares all pairs of distinct fingerprints, so it is for small tables only.
"""

from __future__ import annotations

# The five primes of XXH64.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261
WORD = 1 << 64


def _int(x: int) -> str:
    return f"{x % WORD}::UHUGEINT"


def _sum(*terms: str) -> str:
    return f"(({' + '.join(f'{t}::UHUGEINT' for t in terms)}) % {WORD}::UHUGEINT)::UBIGINT"


def _times(x: str, factor: int) -> str:
    return f"(({x}::UHUGEINT * {_int(factor)}) % {WORD}::UHUGEINT)::UBIGINT"


def _turn(x: str, by: int) -> str:
    """``x`` rotated to the left; the bits that leave are cut off first, as a shift must not overflow."""
    return f"((({x} & {(1 << 64 - by) - 1}::UBIGINT) << {by}) | ({x} >> {64 - by}))"


def _round(acc: str, lane: str) -> str:
    return _times(_turn(_sum(acc, _times(lane, P2)), 31), P1)


def _number(hexed: str, first: str, size: int) -> str:
    """``size`` bytes from byte ``first`` (from 0), the first one lowest."""
    parts = " || ".join(f"substr({hexed}, 2 * ({first} + {i}) + 1, 2)" for i in reversed(range(size)))
    return f"('0x' || {parts})::UBIGINT"


def _fold(lanes: str, first: str, step: str) -> str:
    """``step`` (of ``acc`` and ``lane``) over a list of numbers, from ``first``."""
    return f"list_reduce({lanes}, lambda acc, lane: {step}, {first})"


def _merge(acc: str, v: str) -> str:
    return _sum(_times(f"xor({acc}, {_round('0::UBIGINT', v)})", P1), str(P4))


def xxh64(source: str, seed: int) -> str:
    """CTEs from ``source`` (s text, distinct) to ``hashed`` (s, h UBIGINT)."""
    lanes = f"list_transform(range(0, n // 8), lambda i: {_number('x', '8 * i', 8)})"
    starts = [seed + P1 + P2, seed + P2, seed, seed - P1]
    striped = ", ".join(
        f"CASE WHEN n >= 32 THEN {_fold(f'lanes[1:4 * (n // 32)][{j + 1}:-:4]', f'{start % WORD}::UBIGINT', _round('acc', 'lane'))} END AS v{j}"
        for j, start in enumerate(starts))
    turned = _sum(*[_turn(f"v{j}", by) for j, by in enumerate((1, 7, 12, 18))])
    eight = _sum(_times(_turn(f"xor(acc, {_round('0::UBIGINT', 'lane')})", 27), P1), str(P4))
    four = _sum(_times(_turn(f"xor(e, {_times(_number('x', '8 * (n // 8)', 4), P1)})", 23), P2), str(P3))
    one = _times(_turn(f"xor(acc, {_times('lane', P5)})", 11), P1)
    tail = f"list_transform(range(4 * (n // 4), n), lambda i: {_number('x', 'i', 1)})"
    return f"""
bytes AS (SELECT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n FROM {source}),
laned AS (SELECT s, x, n, {lanes} AS lanes FROM bytes),
striped AS (SELECT *, {striped} FROM laned),
m0 AS (SELECT *, CASE WHEN n >= 32 THEN {turned} END AS t FROM striped),
m1 AS (SELECT * REPLACE ({_merge('t', 'v0')} AS t) FROM m0),
m2 AS (SELECT * REPLACE ({_merge('t', 'v1')} AS t) FROM m1),
m3 AS (SELECT * REPLACE ({_merge('t', 'v2')} AS t) FROM m2),
m4 AS (SELECT * REPLACE ({_merge('t', 'v3')} AS t) FROM m3),
begun AS (SELECT s, x, n, lanes, {_sum(f"coalesce(t, {(seed + P5) % WORD}::UBIGINT)", "n")} AS t FROM m4),
eights AS (SELECT s, x, n, {_fold("lanes[4 * (n // 32) + 1:]", "t", eight)} AS e FROM begun),
fours AS (SELECT s, x, n, CASE WHEN n % 8 >= 4 THEN {four} ELSE e END AS f FROM eights),
ones AS (SELECT s, {_fold(tail, "f", one)} AS g FROM fours),
a1 AS (SELECT s, {_times("xor(g, g >> 33)", P2)} AS g FROM ones),
a2 AS (SELECT s, {_times("xor(g, g >> 29)", P3)} AS g FROM a1),
hashed AS (SELECT s, xor(g, g >> 32) AS h FROM a2)"""


def oracle(shingle: int = 3, max_distance: int = 2, seed: int = 42) -> str:
    """SQL for doc_id, fingerprint and component_id of every row of ``documents``."""
    later = "".join(f", lead(w, {i}) OVER (PARTITION BY r ORDER BY i)" for i in range(1, shingle))
    bits = " + ".join(f"CASE WHEN 2 * count(*) FILTER (WHERE h >> {b} & 1 = 1) > count(*) THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END"
                      for b in range(64))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id::BIGINT AS doc_id, text FROM documents),
split AS (SELECT r, regexp_extract_all(translate(text, '{letters}', '{letters.lower()}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
words AS (SELECT r, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
runs AS (SELECT r, i, n, concat_ws(' ', w{later}) AS s FROM words),
shingles AS (SELECT r, s FROM runs WHERE i <= greatest(1, n - {shingle - 1})),
texts AS (SELECT DISTINCT s FROM shingles),{xxh64("texts", seed)},
voted AS (SELECT r, {bits} AS fp FROM shingles JOIN hashed USING (s) GROUP BY r),
prints AS (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN voted USING (r)),
nodes AS MATERIALIZED (SELECT fp, min(doc_id) AS least FROM prints GROUP BY fp),
links AS MATERIALIZED (
  SELECT a.fp AS a, b.fp AS b FROM nodes a JOIN nodes b ON bit_count(xor(a.fp, b.fp)::UHUGEINT::HUGEINT) <= {max_distance}
),
reach AS (
  SELECT fp AS a, fp AS b FROM nodes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
named AS (SELECT reach.a AS fp, min(least) AS component_id FROM reach JOIN nodes ON nodes.fp = reach.b GROUP BY reach.a)
SELECT doc_id, format('{{:016x}}', fp) AS fingerprint, component_id FROM prints JOIN named USING (fp)
"""
