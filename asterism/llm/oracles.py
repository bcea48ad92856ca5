"""DuckDB SQL of the operators that SQL can express, written from the queries' parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from asterism.llm.licenses import musts, run_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_list(words: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def mixing(
    domain: str, weights: Mapping[tuple[str, ...], int], epochs: int, seed: int
) -> str:
    """Budgets level by level, then full epochs and the prefix of the last one."""
    columns = ["domain", "lang", "source"]
    # The deepest level at which a leaf has no weight: nodes above cannot use its supply.
    shut = ["0"] + [
        f"CASE WHEN [{', '.join(columns[: len(p)])}] = {text_list(p)} THEN {len(p)} ELSE 0 END"
        for p, weight in weights.items()
        if weight <= 0
    ]
    steps = [
        f"""d AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '(none)') AS lang,
          coalesce(source, '(none)') AS source, lang AS own_lang, source AS own_source,
          len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents)""",
        f"""leaves AS (SELECT domain, lang, source, sum(n) AS supply, greatest({', '.join(shut)}) AS shut
          FROM d WHERE n > 0 GROUP BY domain, lang, source)""",
        "n0 AS (SELECT coalesce(sum(supply), 0) AS parent FROM leaves)",
    ]
    for level in range(1, len(columns) + 1):
        path, above = columns[:level], columns[: level - 1]
        given = [f"({text_list(p)}, {w})" for p, w in weights.items() if len(p) == level]
        known = ", ".join(given) or "([''], 0)"
        by = "PARTITION BY " + ", ".join(above) if above else ""
        held = " AND ".join(f"c.{a} = p.{a}" for a in above) or "true"
        named = ", ".join(path)
        order = f"{by} ORDER BY CASE WHEN weight > 0 THEN cap / CAST(weight AS DOUBLE) ELSE 'inf' END, {path[-1]}"
        steps += [
            f"w{level} AS (SELECT * FROM (VALUES {known}) AS v(path, weight))",
            f"""c{level} AS (SELECT {', '.join(f'c.{x}' for x in path)}, c.cap,
              coalesce(w.weight, 1) AS weight, p.parent
              FROM (SELECT {named}, sum(CASE WHEN shut <= {level} THEN supply ELSE 0 END) * {epochs} AS cap
                FROM leaves GROUP BY {named}) c
              JOIN n{level - 1} p ON {held} LEFT JOIN w{level} w ON w.path = [{', '.join(f'c.{x}' for x in path)}])""",
            f"""g{level} AS (SELECT *,
              coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
              sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
              FROM c{level})""",
            f"""f{level} AS (SELECT *, weight > 0 AND CAST(cap AS HUGEINT) * share
              <= CAST(parent - given AS HUGEINT) * weight AS whole FROM g{level})""",
            f"""s{level} AS (SELECT *, sum(CASE WHEN whole THEN cap ELSE 0 END) OVER ({by}) AS spent,
              sum(CASE WHEN whole THEN 0 ELSE weight END) OVER ({by}) AS rest FROM f{level})""",
            f"""n{level} AS (SELECT {named}, CASE WHEN whole THEN cap
              WHEN weight > 0 THEN CAST(weight AS HUGEINT) * (parent - spent) // rest ELSE 0 END AS parent
              FROM s{level})""",
        ]
    steps += [
        """p AS (SELECT *, parent // supply AS epochs, parent % supply AS part
          FROM n3 JOIN leaves USING (domain, lang, source))""",
        f"""o AS (SELECT d.*, p.epochs, p.part, e.epoch, md5('{seed}:' || e.epoch || ':' || doc_id) AS key
          FROM d JOIN p USING (domain, lang, source), LATERAL (SELECT unnest(range(CAST(p.epochs AS BIGINT) + 1)) AS epoch) e
          WHERE d.n > 0)""",
        """t AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source, epoch ORDER BY key) - n AS before
          FROM o)""",
    ]
    return (
        "WITH " + ",\n".join(steps) + """
        SELECT doc_id, own_lang AS lang, own_source AS source, CAST(epoch AS INTEGER) AS epoch,
          CAST(n AS BIGINT) AS n_tokens,
          CAST(CASE WHEN epoch < epochs THEN n ELSE least(n, part - before) END AS BIGINT) AS n_taken
        FROM t WHERE epoch < epochs OR before < part"""
    )


def licenses(
    phrases: Mapping[str, str],
    templates: Sequence[tuple[str, str]],
    threshold: float,
    telling: Sequence[tuple[str, Sequence[str]]],
) -> str:
    """Phrases by position; every window of words against every template."""
    found = ", ".join(
        f"""struct_pack(label := '{label}', places := list_filter(range(1, len(words) + 1),
          lambda i: words[i:i + {len(p.split()) - 1}] = {text_list(p.split())}))"""
        for p, label in phrases.items()
    )
    rows = ", ".join(
        f"('{label}', {text_list(list(dict.fromkeys(text.split())))}, {must})"
        for (label, text), must in zip(templates, musts(templates, telling), strict=True)
    )

    def stands(phrase: str, not_before: Sequence[str]) -> str:
        def at(start: str, words: str) -> str:
            parts = words.split()
            return f"b[{start}:{start} + {len(parts) - 1}] = {text_list(parts)}"

        ways = []
        for one in phrase.split("|"):
            behind = [f"NOT {at(f'i + {len(one.split())}', other)}" for other in not_before]
            holds = " AND ".join([at("i", one), *behind])
            ways.append(f"len(list_filter(range(1, len(b) + 1), lambda i: {holds})) > 0")
        return " OR ".join(ways)

    told = ", ".join(f"CASE WHEN {stands(*one)} THEN {i} END" for i, one in enumerate(telling))
    run = run_of(templates)
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS k,
          translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
        w AS (SELECT doc_id, k, regexp_extract_all(t, {word}) AS words FROM d),
        f AS (SELECT doc_id, k, len(words) AS n_words, [{found}] AS found FROM w),
        b AS (SELECT doc_id, k, n_words, flatten(list_transform(found, lambda x: x.places)) AS places,
          list_transform(list_filter(found, lambda x: len(x.places) > 0), lambda x: x.label) AS base FROM f),
        l AS (SELECT k, words[pos + 1:pos + {2 * run}] AS b
          FROM (SELECT k, words, unnest(range(0, greatest(len(words), 1), {run})) AS pos FROM w)),
        v AS (SELECT * FROM (VALUES {rows}) AS x(label, t, must)),
        c AS (SELECT k, b, label, must, have / CAST(len(t) AS DOUBLE) AS share
          FROM (SELECT *, len(list_intersect(list_distinct(b), t)) AS have FROM l, v)
          WHERE have >= ceil({threshold} * len(t) - 1e-9)),
        m AS (SELECT k, list_distinct(list(label)) AS more, max(share) AS best
          FROM c WHERE list_has_all([{told}], must) GROUP BY k)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
          CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
          array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
          array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
          CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
        FROM b LEFT JOIN m USING (k)"""


def urls(
    rules: Sequence, min_support: float, min_count: int, min_lift: float, number: str
) -> str:
    """Every combination of tokens counted one by one."""
    fits = [
        (r.name, r.verdict, f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')")
        for r in sorted(rules, key=lambda r: -len(r.name))
    ]
    name = " ".join(f"WHEN {fit} THEN '{n}'" for n, _, fit in fits)
    verdict = " ".join(f"WHEN {fit} THEN '{v}'" for _, v, fit in fits)

    def named(kind: str, values: str) -> str:
        return f"list_transform(list_filter({values}, lambda x: x <> ''), lambda x: '{kind}:' || x)"

    listed = ", ".join(
        [
            named("scheme", "[regexp_extract(url, '(?s)^(.*?)://', 1)]"),
            named("host", "list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))"),
            named("folder", "shapes[:-2]"),
            named("last", "shapes[-1:]"),
            named("key", "list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1])"),
            "CASE WHEN contains(url, '#') THEN ['fragment'] ELSE [] END",
            "['folders:' || len(pieces)]",
        ]
    )
    return f"""
        WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
        h AS (SELECT *, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
          regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
          regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1) AS query FROM u),
        s0 AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS pieces,
          string_split(host, '.') AS labels FROM h),
        s AS (SELECT *, list_transform(pieces, lambda x: regexp_replace(x, '[0-9]+', '#', 'g')) AS shapes FROM s0),
        t AS (SELECT page_id, url, host, path, CASE WHEN host = '' THEN [] ELSE
          list_sort(list_distinct(flatten([{listed}]))) END AS tokens FROM s),
        g AS (SELECT doc_id, max((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::INT) AS bad
          FROM labels GROUP BY doc_id),
        k AS (SELECT row_number() OVER () AS id, tokens, bad FROM t JOIN g
          ON g.doc_id = TRY_CAST(nullif(regexp_extract(url, '{number}', 1), '') AS BIGINT) WHERE host <> ''),
        n AS (SELECT count(*) AS rows, ceil(greatest({min_support}::DOUBLE, {min_count}::DOUBLE / count(*))
          * count(*)) AS least, {min_lift}::DOUBLE * (sum(bad) / CAST(count(*) AS DOUBLE)) AS conf FROM k),
        a AS (SELECT token, list(id ORDER BY id) AS ids FROM (SELECT id, unnest(tokens) AS token FROM k)
          GROUP BY token HAVING count(*) >= (SELECT least FROM n)),
        o AS (SELECT min(token) AS token, ids FROM a GROUP BY ids),
        w AS (SELECT id, list_sort(list(token)) AS tokens FROM (SELECT token, unnest(ids) AS id FROM o) GROUP BY id),
        c AS (SELECT words, count(*) AS total, sum(bad) AS bad FROM (
          SELECT bad, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS words FROM (
            SELECT w.*, k.bad, unnest(range(1, (1 << len(w.tokens))::BIGINT)) AS mask
            FROM w JOIN k USING (id))) GROUP BY words),
        r AS (SELECT words, array_to_string(words, ' ') AS rule, bad / CAST(total AS DOUBLE) AS confidence,
          bad / CAST(rows AS DOUBLE) AS support FROM c, n
          WHERE rows >= {min_count} AND bad >= least AND bad / CAST(total AS DOUBLE) >= conf),
        b AS (SELECT page_id, url, rule AS mined, confidence FROM (
          SELECT page_id, url, rule, confidence, row_number() OVER (
            PARTITION BY page_id, url ORDER BY confidence DESC, support DESC, rule DESC) AS place
          FROM (SELECT DISTINCT page_id, url, tokens FROM t) JOIN r ON list_has_all(tokens, words)) WHERE place = 1)
        SELECT t.page_id, host, path, CASE {name} END AS rule,
          CASE {verdict} WHEN mined IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
          mined, confidence
        FROM t LEFT JOIN b ON b.page_id IS NOT DISTINCT FROM t.page_id AND b.url = t.url"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text: bytes are added, -1 stands for a shift by one bit."""
    steps = f"flatten(list_transform(range(1, len({text}) + 1), lambda i: [ord({text}[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(list_reduce({steps}, lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) "
        "ELSE xor(x >> 1, 3988292384 * (x & 1)) END, 4294967295), 4294967295)"
    )


def manifest(fan: int = 16, levels: int = 7) -> str:
    """Trees of up to ``fan ** levels`` leaves, level by level."""

    def framed(name: str) -> str:
        return (
            f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"
        )

    def hashed(text: str) -> str:
        return f"sha256(concat({', '.join(framed(n) for n in ('doc_id', 'source', 'lang', 'n_chars'))}, {framed(text)}))"

    def tree(name: str, base: str) -> list[str]:
        """Levels name0, name1, ... of (g, p, h, n), and the siblings at each of them."""
        out = [f"{name}0 AS ({base})"]
        for level in range(levels):
            run = f"PARTITION BY g, p // {fan} ORDER BY p ROWS BETWEEN"
            out += [
                f"""{name}s{level} AS (SELECT g, p, n,
                  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
                  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
                  FROM {name}{level})""",
                f"""{name}{level + 1} AS (SELECT g, p // {fan} AS p, (min(n) + {fan} - 1) // {fan} AS n,
                  CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
                  FROM {name}{level} GROUP BY g, p // {fan})""",
            ]
        return out

    def climbed(name: str, frm: str, g: str, p: str, extra: str) -> list[str]:
        """Proof and fold along the levels of a tree, for rows of ``frm`` at (g, p)."""
        out, last = [], frm
        for level in range(levels):
            step = f"{name}c{level}"
            out.append(
                f"""{step} AS (SELECT x.* EXCLUDE (proof, seen), CASE WHEN s.n = 1 THEN proof ELSE proof || s.b || s.a END AS proof,
                  CASE WHEN s.n = 1 THEN seen ELSE sha256(s.b || seen || s.a) END AS seen
                  FROM {last} x JOIN {name}s{level} s ON s.g = x.{g} AND s.p = x.{p} // {fan**level})"""
            )
            last = step
        return [*out, f"{name}end AS (SELECT x.*, t.h AS {extra} FROM {last} x JOIN {name}{levels} t ON t.g = x.{g})"]

    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    seen = f"CASE WHEN tampered THEN {hashed('low')} ELSE {hashed('text')} END"
    steps = [
        f"""d AS (SELECT *, {lowered} AS low, coalesce({crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0, false) AS tampered FROM documents)""",
        f"""l AS (SELECT doc_id, coalesce('=' || source, '') AS g, {hashed('text')} AS leaf, {seen} AS seen FROM d)""",
        """r AS (SELECT *, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
          count(*) OVER (PARTITION BY g) AS n FROM l)""",
        *tree("t", "SELECT g, p, leaf AS h, n FROM r"),
        *climbed("t", "r", "g", "p", "subroot"),
        f"""q AS (SELECT g AS name, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM t{levels})""",
        *tree("u", "SELECT '' AS g, p, h, n FROM q"),
        "e AS (SELECT x.* EXCLUDE (p, n, g), '' AS g, q.p FROM tend x JOIN q ON q.name = x.g)",
        *climbed("u", "e", "g", "p", "root"),
    ]
    return (
        "WITH " + ",\n".join(steps) + """
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, seen AS folded_root,
          seen = root AS verified FROM uend"""
    )


def conversations() -> str:
    """The damage; then one row of a conversation after the other, with the cheapest
    (cost, audit) for each last initial so far."""
    ws = r"\x20\x09-\x0D"
    states = "('e'), ('s'), ('u'), ('a')"
    # Texts of length one: inserted turns between two rows, from last initial x to y.
    gaps = (
        "('e','e',0,''), ('s','s',0,''), ('u','u',0,''), ('a','a',0,''), ('e','u',3,'I'), ('s','u',3,'I'), "
        "('a','u',3,'I'), ('u','a',3,'I'), ('e','a',6,'II'), ('s','a',6,'II'), ('a','a',6,'II'), ('u','u',6,'II')"
    )
    follows = "('e','s'), ('e','u'), ('s','u'), ('a','u'), ('u','a')"
    return f"""
        WITH RECURSIVE c0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k FROM conversations),
        c1 AS (SELECT * EXCLUDE (k), {crc32('k')} % 20 AS f FROM c0),
        c2 AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
          CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
          unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c1 WHERE f <> 0),
        c3 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM c2),
        c4 AS (SELECT *, left(role, 1) AS r, NOT regexp_matches(text, '[^{ws}]') AS blank,
          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
          NOT regexp_matches(text, '[.!?][{ws}]*$') AS cut,
          lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS r0 FROM c3),
        rw AS (SELECT *, CASE WHEN blank THEN 'b' WHEN again THEN 'd' WHEN cut THEN 't' ELSE '' END AS fault FROM c4),
        st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
          count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
          count(*) FILTER (fault = 't') AS truncated,
          count(*) FILTER (i > 1 AND (r0 || r) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
          FROM rw GROUP BY conv_id),
        gap AS (SELECT * FROM (VALUES {gaps}) AS v(x, y, cost, audit)),
        nxt AS (SELECT * FROM (VALUES {follows}) AS v(x, y)),
        ed AS (
          SELECT conv_id, i, x AS s0, x AS s1, 4 AS cost, 'D' AS audit FROM rw, (VALUES {states}) AS v(x)
          UNION ALL SELECT conv_id, i, x, y, CASE WHEN fault = 't' THEN 3 ELSE 0 END, 'K' FROM rw JOIN nxt ON y = r
          WHERE fault NOT IN ('b', 'd')
          UNION ALL SELECT conv_id, i, x, y, CASE WHEN fault = 't' THEN 6 ELSE 3 END, 'R' FROM rw JOIN nxt ON y <> 's'
          WHERE fault NOT IN ('b', 'd')),
        sp AS (SELECT conv_id, i, s0, s1, min(struct_pack(cost := cost, audit := audit)) AS b FROM (
          SELECT e.conv_id, e.i, g.x AS s0, e.s1, g.cost + e.cost AS cost, g.audit || e.audit AS audit
          FROM ed e JOIN gap g ON g.y = e.s0) GROUP BY ALL),
        dp AS (
          SELECT conv_id, 0 AS i, 'e' AS s, struct_pack(cost := 0, audit := '') AS b FROM st
          UNION ALL
          SELECT d.conv_id, d.i + 1, p.s1, min(struct_pack(cost := d.b.cost + p.b.cost, audit := d.b.audit || p.b.audit))
          FROM dp d JOIN sp p ON p.conv_id IS NOT DISTINCT FROM d.conv_id AND p.i = d.i + 1 AND p.s0 = d.s
          GROUP BY d.conv_id, d.i, p.s1),
        fin AS (SELECT d.conv_id, min(struct_pack(cost := d.b.cost + g.cost, audit := d.b.audit || g.audit)) AS b
          FROM dp d JOIN st ON st.conv_id IS NOT DISTINCT FROM d.conv_id AND st.n = d.i
          JOIN gap g ON g.x = d.s AND (g.y = 'a' OR (g.y = 'e' AND g.cost = 0)) GROUP BY d.conv_id),
        ltr AS (SELECT conv_id, b.cost AS cost, b.audit AS audit, unnest(range(1, len(b.audit) + 1)) AS j FROM fin),
        pos AS (SELECT conv_id, j, audit[j] AS e,
          count(*) FILTER (audit[j] <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
          count(*) FILTER (audit[j] <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS k FROM ltr),
        sys AS (SELECT p.conv_id, bool_or(p.k = 1 AND p.e = 'K' AND w.r = 's') AS sys
          FROM pos p JOIN rw w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i GROUP BY p.conv_id),
        tx AS (SELECT p.conv_id, p.j, CASE WHEN p.e = 'K' THEN w.role
            WHEN (p.k + CASE WHEN y.sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN p.e = 'I' THEN '' ELSE w.text END AS line
          FROM pos p JOIN sys y ON y.conv_id IS NOT DISTINCT FROM p.conv_id
          LEFT JOIN rw w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i WHERE p.e <> 'D'),
        out AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS repaired FROM tx GROUP BY conv_id)
        SELECT a.conv_id, coalesce(st.gaps, 0)::BIGINT AS gaps, coalesce(st.blank, 0)::BIGINT AS blank,
          coalesce(st.duplicate, 0)::BIGINT AS duplicate, coalesce(st.truncated, 0)::BIGINT AS truncated,
          coalesce(st.illegal, 0)::BIGINT AS illegal, coalesce(fin.b.cost, 0)::BIGINT AS cost,
          coalesce(fin.b.audit, '') AS audit, coalesce(out.repaired, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN out ON out.conv_id IS NOT DISTINCT FROM a.conv_id"""
