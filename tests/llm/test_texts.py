"""Byte BPE, word pieces, fingerprints and substrings against plain versions."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash

from pairsift.llm import byte_bpe, fingerprints, queries, recompression, substrings, word_pieces
from tests.llm.helpers import documents, got, odd_rows, with_clashes, words_of

PATH = public_tokenizers.path(queries.RANKS)
RANKS = byte_bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = ["a", "the", "  ", " ", "\n", "é", "ß", "123", "...", "ing", "'s", "'re", "\t", "漢", "😀", "aaaa", "haha", "　", "\x1c", "½", "\xa0", "<|endoftext|>"]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_bpe_of_odd_rows(spark):
    rows = odd_rows()
    expect = []
    for doc_id, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        expect.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    docs = with_clashes(documents(spark, rows))
    result = byte_bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN)
    assert got(result) == sorted(expect, key=repr)


def test_bpe_round_trip(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    ids = byte_bpe.encode_ids(docs, PATH, public_tokenizers.PATTERN)
    assert got(byte_bpe.decode_ids(ids, PATH)) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_bpe_of_random_texts():
    codec, rnd = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN), random.Random(1)
    for _ in range(1500):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40)))
        ids = LIBRARY.encode_ordinary(text)
        assert codec.ids(text) == ids
        assert codec.digest(text) == (len(ids), sha(" ".join(map(str, ids))), sha(text))
        assert codec.decode(ids) == text.encode()


def test_bpe_memo_may_be_small(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO", 3)
    test_bpe_of_random_texts()


def test_appends_and_edits():
    vocabulary, rnd = byte_bpe.Vocabulary(RANKS), random.Random(2)
    letters = b"abtheing =\xc3\xa9"
    draw = lambda most: bytes(rnd.choice(letters) for _ in range(rnd.randint(0, most)))
    for _ in range(60):
        table = byte_bpe.PrefixTable(vocabulary, draw(900))
        more = draw(50)
        whole = byte_bpe.PrefixTable(vocabulary, table.text + more)
        table.append(more)
        assert table.last == whole.last and table.encoding() == whole.encoding()
        start = rnd.randint(0, len(table.text))
        end, new = rnd.randint(start, min(len(table.text), start + 30)), draw(20)
        whole = byte_bpe.PrefixTable(vocabulary, table.text[:start] + new + table.text[end:])
        table.replace(start, end, new)
        assert (table.text, table.last, table.length) == (whole.text, whole.last, whole.length)


def greedy(word, vocabulary):
    count = 0
    while word:
        length = next((n for n in range(len(word), 0, -1) if word[:n] in vocabulary), 0)
        if not length:
            return 0
        word, count = word[length:], count + 1
    return count


def test_piece_counter_against_greedy():
    rnd = random.Random(3)
    for _ in range(150):
        vocabulary = {"".join(rnd.choices("abcd", k=rnd.randint(1, 6))) for _ in range(rnd.randint(1, 25))}
        counter = word_pieces.PieceCounter(vocabulary)
        for _ in range(60):
            word = "".join(rnd.choices("abcde" if rnd.random() < 0.2 else "abcd", k=rnd.randint(1, 20)))
            assert counter.count(word) == greedy(word, vocabulary), (word, vocabulary)


def test_piece_counts_of_odd_rows(spark):
    rows = odd_rows()
    vocabulary = {"▁w", "▁na", "1", "2", "12", "23", "3", "▁", "w", "n", "a", "▁chan", "ged", "4", "5", "6", "7", "8", "9", "0"}
    expect = []
    for doc_id, text in rows:
        counts = [greedy("▁" + word, vocabulary) for word in words_of(text)]
        expect.append((doc_id, len(counts), sum(n or 1 for n in counts), counts.count(0)))
    result = word_pieces.count_pieces(with_clashes(documents(spark, rows)), vocabulary, "test")
    assert got(result) == sorted(expect, key=repr)


def test_piece_counts_with_the_real_vocabulary(spark):
    """All documents of a table, word by word against the longest piece that fits, again and again."""
    folder = "/root/testdata/sf0.001"
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    vocabulary, known = {model.id_to_piece(i) for i in plain}, {}
    longest = max(map(len, vocabulary))

    def pieces(word):
        if word not in known:
            at, count = 0, 0
            while at < len(word):
                size = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in vocabulary), 0)
                if not size:
                    count = 0
                    break
                at, count = at + size, count + 1
            known[word] = count
        return known[word]

    expect = []
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        counts = [pieces("▁" + word) for word in words_of(row.text)]
        expect.append((row.doc_id, len(counts), sum(n or 1 for n in counts), counts.count(0)))
    assert got(queries.op7_token_counts(spark, folder)) == sorted(expect, key=repr)


def shingles(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints(spark, conf):
    conf("spark.sql.shuffle.partitions", "3")
    rows = odd_rows()
    k = 1 << 16  # all shingles: the estimates are exact
    docs = with_clashes(documents(spark, rows))
    found = fingerprints.compare_with_edits(docs, k=k, parts=5).collect()
    ordered = in_order(rows)
    expect = []
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]

        def alike(a, b):
            return len(a & b) / len(a | b) if a | b else 1.0

        own = shingles(text)
        near = alike(own, shingles(edited)), alike(own, shingles(following))
        expect.append((doc_id, len(text), sha(edited), *(round(x, 9) for x in near)))
    plain = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(plain, key=repr) == sorted(expect, key=repr)


def in_order(rows):
    """By id, rows without one first; rows of one id by the hash of their text."""
    place = lambda text: xxhash.xxh64_intdigest(text.encode(), 42) >> 1
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, place(r[1]), r[1]))


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def sketch_of(text, k=128):
    """The least hashes of the shingles, hashed word by word and then number by number."""
    words = [signed(xxhash.xxh64_intdigest(word.encode(), 42)) for word in words_of(text)]
    found = set()
    for shingle in [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []:
        value = 42
        for number in shingle:
            value = xxhash.xxh64_intdigest(number.to_bytes(8, "little", signed=True), value)
        found.add(signed(value))
    return sorted(found)[:k]


def test_fingerprint_strings(spark):
    rows = odd_rows()
    found = fingerprints.compare_with_edits(documents(spark, rows)).collect()
    ordered, expect = in_order(rows), []
    near = lambda a, b: len(set(a) & set(b) & set(union)) / len(union) if (union := sorted({*a, *b})[:128]) else 1.0
    text_of = lambda sketch: "".join(f"{h % (1 << 64):016X}" for h in sketch)
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        own, edited = sketch_of(text), sketch_of(text[: len(text) - half] + following[:half])
        numbers = round(near(own, edited), 9), round(near(own, sketch_of(following)), 9)
        expect.append((doc_id, text_of(own), text_of(edited), *numbers))
    plain = [(r.doc_id, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(plain, key=repr) == sorted(expect, key=repr)


@pytest.mark.parametrize("hot", [None, 77])
def test_many_rows_of_one_id_are_cut(spark, hot):
    """A third of the rows have no id, or the same one: they are many ranges, and the order holds."""
    rows = [(hot if i % 3 == 0 else i, f"text {i} of some words") for i in range(1500)]
    docs = documents(spark, rows).selectExpr("doc_id", "text")
    docs = docs.withColumn("place", fingerprints.text_order(docs.text))
    cut = docs.withColumn("part", fingerprints.ranges(docs, "doc_id", "place", 16)).collect()
    sizes = sorted(Counter(r.part for r in cut).values())
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2] and sizes[-1] < 100
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.place)
    ordered = sorted(cut, key=key)
    assert [r.part for r in ordered] == sorted(r.part for r in cut)
    found = fingerprints.compare_with_edits(documents(spark, rows), parts=16).collect()
    by_hand = in_order(rows)
    expect = []
    for at, (doc_id, text) in enumerate(by_hand):
        half = len(text) // 2
        expect.append((doc_id, sha(text[: len(text) - half] + by_hand[(at + 1) % len(by_hand)][1][:half])))
    assert sorted(((r.doc_id, r.edited_sha256) for r in found), key=repr) == sorted(expect, key=repr)


def test_sketches_estimate(spark):
    rnd = random.Random(4)
    words = [str(rnd.random()) for _ in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[500:3000])
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for name in "ab":
        df = fingerprints.with_sketch(df, name, f"s{name}")
    row = df.select(
        fingerprints.resemblance(df.sa, df.sb).alias("near"),
        fingerprints.containment(df.sa, df.sb).alias("inside"),
        fingerprints.distinct_shingles(df.sa).alias("n"),
    ).first()
    assert abs(row.near - 1496 / 2996) < 0.15
    assert abs(row.inside - 1496 / 1996) < 0.25
    assert abs(row.n / 1996 - 1) < 0.3


def test_sketches_merge(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e x y"), (2, "one two"), (2, "")]
    df = fingerprints.with_sketch(spark.createDataFrame(rows, "k int, t string"), "t", "s")
    both = {r.k: r.s for r in fingerprints.merged(df, "k", "s").collect()}
    parts = {}
    for r in df.collect():
        parts.setdefault(r.k, set()).update(r.s)
    assert both == {k: sorted(v) for k, v in parts.items()}


@pytest.mark.parametrize("rows", [[(7, "only one text here with words")], [(None, "a b"), (None, "c d")], [(1, "abcd")] * 3])
def test_fingerprints_of_few_rows(spark, rows):
    found = fingerprints.compare_with_edits(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    if len(rows) != 2:
        assert all(r.near_next == 1.0 for r in found)


def shortened(rows, width):
    last = (1 << 63) - 1
    first = {}
    for doc_id, text in rows:
        words = words_of(text)
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first[key] = min(first.get(key, last), last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < (last if doc_id is None else doc_id):
                gone[i : i + width] = [True] * width
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), sha(left), left))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, rounds", [(13, 2), (13, 3), (4, 2), (13, 0)])
def test_substrings_of_odd_rows(spark, width, rounds):
    rows = odd_rows()
    docs = with_clashes(documents(spark, rows))
    result = substrings.dedup(docs, width, rounds, with_text=True)
    assert got(result) == shortened(rows, width)


def test_substrings_of_few_words(spark):
    """Runs, periods and chance repeats."""
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices("ab", k=rnd.randint(0, 80)))) for i in range(30)]
    rows += [(100 + i, "a b " * (10 + i)) for i in range(5)] + [(200 + i, "a " * (9 + 3 * i)) for i in range(5)]
    assert got(substrings.dedup(documents(spark, rows), with_text=True)) == shortened(rows, 13)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "WINDOWS_AT_ONCE", 16)
    monkeypatch.setattr(recompression, "WORDS_AT_ONCE", 8)
    rnd = random.Random(6)
    texts = [[f"w{rnd.randint(0, 3)}" for _ in range(rnd.randint(0, 200))] for _ in range(12)]
    import numpy as np

    data = [" ".join(t).encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    words = recompression.words_of(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert words.sizes.tolist() == [len(t) for t in texts]
    one = recompression.window_keys(words.hashes[:, 0], words.sizes, 13, 2)[1]
    keys = []
    for _, key, span in substrings.spans_of(words.hashes[:, 0], words.sizes, 13, 2):
        keys += np.repeat(key, span & 4095).tolist()
    assert keys == one.view(np.int64).tolist()


def test_equal_windows_have_equal_keys():
    import numpy as np

    rnd = np.random.default_rng(7)
    hashes = recompression.mixed(rnd.integers(0, 5, 4000).astype(np.uint64) + np.uint64(1))
    sizes = np.array([0, 5, 1200, 13, 2000, 782])
    starts, keys = recompression.window_keys(hashes, sizes, 13, 3)
    seen = {}
    for start, key in zip(starts.tolist(), keys.tolist()):
        assert seen.setdefault(hashes[start : start + 13].tobytes(), key) == key


@pytest.mark.parametrize("run", [
    lambda d: byte_bpe.encode_digests(d, PATH, public_tokenizers.PATTERN),
    lambda d: word_pieces.count_pieces(d, ["a"], "one"),
    fingerprints.compare_with_edits,
    substrings.dedup,
])
def test_empty_table(spark, run):
    assert run(documents(spark, [(1, "x")]).where("doc_id > 1")).collect() == []


def test_tables(spark):
    """The queries over whole tables, held against the plain versions."""
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    removed = got(queries.QUERIES["op9_substring_dedup"](spark, folder))
    assert removed == [row[:4] for row in shortened(rows, 13)]
    digests = {r.doc_id: r.n_tokens for r in queries.QUERIES["op6_byte_bpe"](spark, folder).collect()}
    assert digests == {i: len(LIBRARY.encode_ordinary(t or "")) for i, t in rows}
    counts = queries.QUERIES["op7_token_counts"](spark, folder).collect()
    assert {r.doc_id: r.n_words for r in counts} == {i: len(words_of(t)) for i, t in rows}
