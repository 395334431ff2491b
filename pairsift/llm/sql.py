"""The queries as SQL for DuckDB, where SQL can say them."""

from __future__ import annotations

from pairsift.llm import licenses as lic
from pairsift.llm import mixing as mix

# CRC-32 of a byte table, one bit at a time for its 256 entries.
CRC_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
CRC_TABLE = """
steps AS (SELECT range AS i, range::BIGINT AS c, 0 AS round FROM range(256)
          UNION ALL SELECT i, """ + CRC_STEP.format(c="c") + """, round + 1 FROM steps WHERE round < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE round = 8)"""

EXACT_DEDUP = """
WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
           FROM documents GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(t) AS text_sha256
FROM documents JOIN g ON coalesce(text, '') = t
"""

SUBSTRINGS = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
hits AS (SELECT doc_id, i FROM win JOIN firsts USING (s) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hits),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
sides AS (SELECT words.doc_id, count(gone.p) AS n_removed,
                 string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept
          FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY ALL)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN sides USING (doc_id)
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, t FROM (SELECT doc_id, regexp_extract_all(
             translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents)),
total AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS length FROM d WHERE len(t) > 0),
posting AS (SELECT r, doc_id, term, count(*) AS tf, n
            FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total),
i AS (SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
score AS (SELECT item, item_id, r, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // length))))::BIGINT AS score
          FROM (SELECT item, item_id, unnest(t) AS term FROM i) JOIN w USING (term) JOIN posting USING (term), total
          GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank,
       doc_id, score
FROM score QUALIFY rank <= 50
"""


def manifest(width: int = 16) -> str:
    """All levels of all trees as lists, and every leaf's way through them."""
    fields = " || ".join(
        f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    text = "coalesce(strlen({t}) || ':' || {t}, '-')"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"

    def levels(name: str, source: str) -> str:
        runs = (
            f"list_transform(range(0, len(nodes), {width}),"
            f" lambda i: sha256(array_to_string(nodes[i + 1 : i + {width}], '')))"
        )
        return (
            f"{name} AS (SELECT tree, 0 AS level, list(digest ORDER BY pos) AS nodes FROM {source} GROUP BY tree"
            f" UNION ALL SELECT tree, level + 1, {runs} FROM {name} WHERE len(nodes) > 1)"
        )

    def ways(name: str, source: str, trees: str) -> str:
        """For every node of the lowest level the siblings left and right, level by level."""
        at = f"(pos // ({width}**level)::BIGINT)"
        run = f"({at} // {width}) * {width}"
        return (
            f"{name} AS (SELECT tree, pos, list({{'a': array_to_string(nodes[{run} + 1 : {at}], ''),"
            f" 'b': array_to_string(nodes[{at} + 2 : {run} + {width}], '')}} ORDER BY level) AS way"
            f" FROM {source} JOIN {trees} USING (tree) WHERE len(nodes) > 1 GROUP BY tree, pos)"
        )

    return f"""
WITH RECURSIVE {CRC_TABLE.strip()},
crc AS (SELECT doc_id AS id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
          list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
        FROM (SELECT DISTINCT doc_id FROM documents), crc_table),
l AS (SELECT coalesce('=' || source, '') AS tree, doc_id, sha256({fields} || {text.format(t='text')}) AS digest,
        CASE WHEN crc % 5 = 0 THEN sha256({fields} || {text.format(t=lowered)})
             ELSE sha256({fields} || {text.format(t='text')}) END AS found
      FROM documents JOIN crc ON doc_id IS NOT DISTINCT FROM id),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM l),
{levels('trees', 'leaves')},
subroots AS (SELECT tree AS name, '' AS tree, nodes[1] AS digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos
             FROM trees WHERE len(nodes) = 1),
{levels('tops', 'subroots')},
{ways('low', 'leaves', 'trees')},
{ways('high', 'subroots', 'tops')},
whole AS (SELECT leaves.doc_id, leaves.digest AS leaf, found, subroots.digest AS subroot,
            (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
            list_concat(coalesce(low.way, []), coalesce(high.way, [])) AS way
          FROM leaves JOIN subroots ON leaves.tree = subroots.name
          LEFT JOIN low ON low.tree = leaves.tree AND low.pos = leaves.pos
          LEFT JOIN high ON high.pos = subroots.pos),
done AS (SELECT *, sha256(array_to_string(list_transform(way, lambda s: s.a || s.b), '')) AS proof_sha256,
           list_reduce(list_concat([{{'a': found, 'b': ''}}], way),
             lambda x, s: {{'a': sha256(s.a || x.a || s.b), 'b': ''}}).a AS folded_root
         FROM whole)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
"""


def sharding(shards: list[int], grown: list[int], slot_buckets: int = 64, cut_bits: int = 4) -> str:
    bids = ", ".join(
        f"-ln((('0x' || substr(md5(k || '|{s}'), 1, 13))::BIGINT + 0.5) / 16.0**13)" for s in grown
    )
    return f"""
WITH RECURSIVE {CRC_TABLE.strip()},
keyed AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
bytes AS (SELECT doc_id, k, regexp_extract_all(hex(encode(t)), '..') AS h, octet_length(encode(t)) AS n FROM keyed),
sums AS (SELECT doc_id, k, n + 1 AS size,
    xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT],
        list_transform(h, lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM bytes, crc_table),
bids AS (SELECT *, [{bids}] AS b FROM sums),
placed AS (SELECT *, list_position(b[:{len(shards)}], list_min(b[:{len(shards)}])) - 1 AS shard,
    list_position(b, list_min(b)) - 1 AS grown_shard,
    ('0x' || substr(md5(k), 1, 6))::INTEGER % {slot_buckets} AS bucket FROM bids)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law,
       shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, text_crc32 >> {32 - cut_bits}, doc_id, text_crc32, size) - 1 AS slot
FROM placed
"""


def mixing(share: float = 0.5, seed: int = 1, sweeps: int = 12) -> str:
    names = list(mix.POWERS)
    topic = " ".join(
        f"WHEN regexp_matches(t, '{pattern}') THEN '{name}'" for name, pattern in mix.TOPICS
    )
    parts = [f"""
WITH d AS (SELECT *, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang,
        CASE {topic} ELSE '{mix.OTHER_TOPIC}' END AS topic,
        greatest(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')), 1) AS n_tokens,
        coalesce(doc_id::VARCHAR, 'text ' || md5(t)) AS k FROM d),
c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM r GROUP BY ALL)"""]
    for name, power in mix.POWERS.items():
        parts.append(
            f"g_{name} AS MATERIALIZED (SELECT {name}, pow(sum(tokens), {power}) AS target FROM c GROUP BY 1)"
        )
        parts.append(
            f"h_{name} AS MATERIALIZED (SELECT {name}, target / (SELECT sum(target) FROM g_{name})"
            f" * (SELECT sum(tokens) FROM c) * {share} AS goal FROM g_{name})"
        )
    parts.append(f"w0 AS (SELECT *, tokens * {share} AS wanted FROM c)")
    last = 0
    for _ in range(sweeps):
        for name in names:
            parts.append(
                f"w{last + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, least(tokens, wanted * goal"
                f" / sum(wanted) OVER (PARTITION BY {name})) AS wanted FROM w{last} JOIN h_{name} USING ({name}))"
            )
            last += 1
    return ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, n_tokens, round(wanted / tokens, 6) AS probability,
       ('0x' || substr(md5('{seed}|' || k), 1, 13))::BIGINT / 16.0**13 < wanted / tokens AS sampled
FROM r JOIN w{last} USING (source, lang, topic)
"""


def licenses() -> str:
    known = {lic.normal(sentence): name for name, sentence in lic.SENTENCES}
    lookup = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in known.items()) + "}"
    longest = max(len(sentence.split(" ")) for sentence in known)

    def normal(text: str) -> str:
        return f"trim(regexp_replace(lower({text}), '{lic.NOT_LETTERS}', ' ', 'g'))"

    def ids(text: str) -> str:
        return (
            f"list_filter(list_transform(string_split_regex({text}, '{lic.SENTENCE_END}'),"
            f" lambda s: known[{normal('s')}]), lambda x: x IS NOT NULL)"
        )

    # Sentences that begin and end with lines: for each line the longest one from there,
    # and of these, from the first on, the ones that do not overlap.
    pieces = (
        f"list_transform(string_split_regex(regexp_replace(t, '{lic.PARAGRAPH}', '. ', 'g'), '{lic.MARK}'),"
        f" lambda p: list_filter(list_transform(string_split(p, chr(10)), lambda s: {normal('s')}), lambda s: s <> ''))"
    )
    from_line = (
        f"list_filter(list_transform(range(1, least({longest}, len(l) - i) + 1),"
        " lambda c: {'at': i, 'until': i + c, 'ids': [known[array_to_string(l[i + 1 : i + c], ' ')]]}),"
        " lambda m: m.ids[1] IS NOT NULL)[-1]"
    )
    runs = (
        "flatten(list_transform(pieces, lambda l: list_reduce(list_concat("
        "[{'at': 0::BIGINT, 'until': 0::BIGINT, 'ids': []::VARCHAR[]}],"
        f" list_filter(list_transform(range(len(l)), lambda i: {from_line}), lambda m: m IS NOT NULL)),"
        " lambda done, m: CASE WHEN m.at >= done.until"
        " THEN {'at': m.at, 'until': m.until, 'ids': list_concat(done.ids, m.ids)} ELSE done END).ids))"
    )

    def rules(column: str) -> str:
        """Rules one after another, each on what the ones before have left."""
        steps, rest = [], f"'|' || array_to_string({column}, '||') || '|'"
        for i, (name, sequence) in enumerate(lic.RULES):
            wanted = "".join(f"|{x}|" for x in sequence)
            steps.append((f"{column}_{i}", rest, wanted, name))
            rest = f"replace({column}_{i}, '{wanted}', '')"
        columns = ", ".join(f"{rest} AS {alias}" for alias, rest, _, _ in steps)
        names = ", ".join(
            f"CASE WHEN contains({alias}, '{wanted}') THEN '{name}' END" for alias, _, wanted, name in steps
        )
        # Later columns of a SELECT may use earlier ones by name.
        return f"{columns}, [{names}] AS n_{column}"

    hints = " OR ".join(f"contains(lower(t), '{w}')" for w in lic.HINTS)
    joined = (
        f"regexp_replace(regexp_replace(t, '{lic.PARAGRAPH}', '. ', 'g'), '{lic.BROKEN_LINE}', ' ', 'g')"
    )
    return f"""
WITH catalogue AS MATERIALIZED (SELECT {lookup} AS known),
a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS MATERIALIZED (SELECT doc_id, {ids('t')} AS ids_lines, {ids(joined)} AS ids_joined, {pieces} AS pieces, {hints} AS hinted
      FROM a, catalogue),
c AS MATERIALIZED (SELECT doc_id, hinted, ids_lines, ids_joined, {runs} AS ids_runs FROM b, catalogue),
d AS MATERIALIZED (SELECT *, {rules('ids_lines')}, {rules('ids_joined')}, {rules('ids_runs')} FROM c),
two AS (SELECT *, CASE WHEN len(ids_joined) > len(ids_lines) THEN ids_joined ELSE ids_lines END AS ids_two FROM d),
e AS (SELECT doc_id, hinted, CASE WHEN len(ids_runs) > len(ids_two) THEN ids_runs ELSE ids_two END AS ids,
        list_sort(list_distinct(list_filter(list_concat(n_ids_lines, n_ids_joined, n_ids_runs),
          lambda x: x IS NOT NULL))) AS names
      FROM two)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(names, ','), '') AS licenses,
       CASE WHEN len(names) > 0 THEN 'known' WHEN len(ids) > 0 THEN 'sentences'
            WHEN hinted THEN 'unknown' ELSE 'none' END AS status
FROM e
"""
