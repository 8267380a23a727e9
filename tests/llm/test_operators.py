"""The operators against brute force, and on odd rows."""

import collections
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from clickspark.llm import (
    chat,
    decontamination,
    language_id,
    quality_rules,
    sentencepiece_codec,
    simhash_dedup,
    token_files,
    toxicity,
    warc,
)
from clickspark.llm.components import components
from clickspark.llm.words import BARE, hash_spans, split_words
from clickspark.sources.shared import shared_path

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ODD = [(100, None), (101, ""), (102, " \n\t"), (None, "a b"), (None, None), (103, "#### $$ 12")]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdeABCé", k=draw.randint(1, 7))) for _ in range(300)]
    rows = []
    for i in range(80):
        text = draw.choices(words, k=draw.choice([1, 3, 4, 5, 40, 200, 700]))
        rows.append((i, " ".join(text)))
        if i % 4 == 0:  # copies, exact and near
            text[draw.randrange(len(text))] = "other"
            rows += [(1000 + i, rows[-1][1]), (2000 + i, "\n".join(text)), rows[-1]]
    rows.append((3000, " ".join(draw.choices(words, k=40_000))))
    return rows + ODD


# Groups


def brute_groups(n, linked):
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)]
    links += [(1, 0), (5000, 5000), (None, 3), (7, None), (6000, 6001), (6001, 6000)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = collections.defaultdict(set)
    for row in got:
        groups[row.root].add(row.node)
    assert sorted(map(sorted, groups.values())) == [
        list(range(201)), list(range(1000, 1100)), [6000, 6001],
    ]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def simhash(text):
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    runs = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, texts):
    got = simhash_dedup.near_duplicates(frame(spark, texts)).collect()
    prints = [simhash(t) for _, t in texts]
    group = brute_groups(len(texts), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for g, (doc_id, _) in zip(group, texts):
        ids = [x for x in (least.get(g), doc_id) if x is not None]
        least[g] = min(ids) if ids else None
    want = [(doc_id, p, least[g]) for g, p, (doc_id, _) in zip(group, prints, texts)]
    assert sorted(map(repr, want)) == sorted(
        repr((r.doc_id, r.fp % (1 << 64), r.component_id)) for r in got
    )


def test_close_fingerprints_of_a_dense_group(spark):
    draw = random.Random(4)
    prints = {0, *(sum(1 << b for b in draw.sample(range(24), draw.randint(1, 6))) for _ in range(300))}
    prints = sorted(prints | {draw.getrandbits(63) for _ in range(200)})
    got = simhash_dedup.close_fingerprints(spark.createDataFrame([(p,) for p in prints], "node long"))
    roots = {r.node: r.root for r in got.collect()}
    group = brute_groups(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    found = collections.defaultdict(set)
    for p, g in zip(prints, group):
        found[g].add(roots.get(p, p))
    assert all(len(r) == 1 for r in found.values())
    assert len({min(r) for r in found.values()}) == len(found)


def test_one_document_of_a_group_stays(spark):
    docs = frame(spark, [(2, "a b c d e"), (1, "A b c d e"), (1, "a b c d e"), (3, "x")])
    kept = simhash_dedup.keep_one(docs.withColumn("fp", F.lit("mine"))).collect()
    assert sorted(map(tuple, kept)) == [(1, "A b c d e", "mine"), (3, "x", "mine")]
    assert simhash_dedup.keep_one(docs.limit(0)).count() == 0


def test_rows_without_an_id_or_with_a_repeated_one_stay(spark):
    rows = [
        (2, "p q r s t"), (5, "P q r s t"), (5, "all by itself it is"),
        (None, "one two three four"), (None, "five six seven eight"), (None, "p q r s t"),
        (7, "u v w x"), (7, "k l m n o"), (None, None), (None, "u v w x"), (7, "u v w x"),
    ]
    want = [rows[0], *rows[2:5], *rows[6:9]]
    kept = simhash_dedup.keep_one(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))


# Chats


def test_chats_are_read_back(spark):
    rows = [
        (1, 1, "assistant", "</turn>\n### User: \\h \\\\l"), (1, 0, "user", "a: b # <"),
        (2, 0, "user", None), (2, 0, "user", None), (3, 0, "tool: #", "x"), (3, None, None, "y"),
        (None, 0, "system", ""), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "é😀"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("segments", F.lit(1))
    got = chat.format_chats(turns).select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("segments")).alias("learnt"), "valid", "bad_turn", "n_turns",
    )
    found = {r.conv_id: r for r in got.collect()}
    want = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want[conv].append((role or "", text or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in found.items()} == dict(want)
    assert found[1].learnt == rows[0][3] and found[4].learnt == "é😀" and found[2].learnt == ""
    assert {k: (r.valid, r.bad_turn) for k, r in found.items()} == {
        1: (True, None), 2: (False, 1), 3: (False, 0), None: (False, None), 4: (True, None),
    }
    assert chat.format_chats(turns.limit(0)).count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.load(public_tokenizers.path("piece_bpe_32k.model"))


def brute_viterbi(pieces, scores, text):
    text = ("▁" + text.replace(" ", "▁")) if text else ""
    best, back = [0.0] + [-1e300] * len(text), [None] * (len(text) + 1)
    for i, char in enumerate(text):
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in scores and best[i] + scores[text[i:j]][0] > best[j]:
                best[j], back[j] = best[i] + scores[text[i:j]][0], (i, [scores[text[i:j]][1]])
        if char not in scores and best[i] + pieces.unknown_score > best[i + 1]:
            best[i + 1] = best[i] + pieces.unknown_score
            back[i + 1] = (i, [int(pieces.byte_id[b]) for b in char.encode()])
    out, at = [], len(text)
    while at:
        out, at = back[at][1] + out, back[at][0]
    return out


def test_sentencepiece_against_brute_force(spark, pieces):
    ids = {int(p): float(s) for p, s in zip(pieces.piece, pieces.score) if p >= 0}
    scores = {pieces.surface[i].decode().replace(" ", "▁"): (s, i) for i, s in ids.items()}
    draw = random.Random(3)
    parts = [*"abcdeéß日😀 \n\t.,019▁", "the", "   ", "tion", "▁▁", "a" * 120]
    rows = [(i, "".join(draw.choices(parts, k=draw.randint(0, 50)))) for i in range(300)] + ODD
    docs = frame(spark, rows).withColumn("decoded", F.lit(0))
    got = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, pieces), pieces).collect()
    want = [
        (d, brute_viterbi(pieces, scores, t or ""), (t or "").replace("▁", " ")) for d, t in rows
    ]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, r.decoded)) for r in got)
    assert sentencepiece_codec.encode(docs.limit(0), pieces).count() == 0


# Decontamination


def runs_of(text):
    words = re.split(r"[\t-\r !-/:-@\[-`{-~]+", (text or "").lower())
    words = [w for w in words if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_contained_items_against_brute_force(spark, texts):
    draw = random.Random(8)
    items = []
    for i, (_, text) in enumerate(texts[:60]):
        words = text.split()
        at = draw.randrange(len(words))
        some = words[at : at + draw.choice([2, 5, 6, 20, 50])]
        if len(some) > 8 and draw.random() < 0.5:
            some[draw.randrange(len(some))] = "changed"
        items.append((i, ", ".join(some)))
    items += [(70, None), (71, ""), (None, texts[5][1]), items[0]]
    want = []
    for doc_id, text in texts:
        mine = runs_of(text)
        for item_id, item in items:
            his = runs_of(item)
            shared = len(mine & his)
            if his and shared >= 0.8 * len(his) - 1e-9:
                want.append((doc_id, item_id, len(his), shared, shared / len(his)))
    docs, bench = frame(spark, texts), frame(spark, items, "item_id int, text string")
    for chars in (300, 1 << 20):  # in several passes and in one
        got = decontamination.contained(docs, bench, chars=chars).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    bad = {repr(x) for x in texts if any(w[0] == x[0] for w in want if w[0] is not None)}
    left = {repr(tuple(r)) for r in decontamination.clean(docs, bench).collect()}
    assert left == {repr(x) for x in texts} - bad
    assert decontamination.contained(docs.limit(0), bench).count() == 0
    assert decontamination.contained(docs, bench.limit(0)).count() == 0


# WARC


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(spark, compress):
    long_one = "é" * 600
    pages = [
        (1, "http://a", long_one), (2, "http://b\r\nX: y", long_one), (3, None, "short"),
        (4, "http://c", "short"), (5, "http://d", None), (2, "http://b", long_one), (9, "u", "x" * 300_000),
        (None, "n", long_one),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    files = warc.write_warc(warc.page_records(table), path, compress=compress)
    assert files.agg(F.sum("n_records")).first()[0] == len(pages)
    rows = warc.read_warc(spark, path).collect()
    found = collections.Counter(
        (warc_id(r.record_id), r.record_type, warc_id(r.refers_to), r.payload_length, r.payload_digest, bytes(r.payload) if r.payload is not None else None)
        for r in rows
    )
    def record(page, kind, to, html):
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        return page, kind, to, len(data), digest, data if kind == "response" else None
    assert found == collections.Counter([
        record("1", "revisit", "2", long_one), record("2", "response", None, long_one),
        record("2", "response", None, long_one), record("none", "revisit", "2", long_one),
        record("3", "response", None, "short"), record("4", "response", None, "short"),
        record("5", "response", None, None), record("9", "response", None, "x" * 300_000),
    ])
    assert any(r.target_uri == "http://b%0D%0AX: y" for r in rows)
    lean = warc.read_warc(spark, path, payload="false").where("record_type = 'revisit'")
    assert {(r.payload_length, r.payload) for r in lean.collect()} == {(1200, None)}
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter record_type" not in plan
    like = warc.read_warc(spark, path).where("target_uri like 'http://%' and record_type in ('response', 'x')")
    assert like.count() == 4


def warc_id(urn):
    return urn and urn.rsplit(":", 1)[1]


def test_archives_without_noted_lengths_and_empty_ones(spark):
    path = shared_path(spark, "test-warc")
    row = dict(record_type="response", record_id="urn:page:1", target_uri="u", refers_to=None)
    whole = [
        warc.encode_record(row | dict(payload=b"x" * n, payload_length=n, payload_digest="00" * 20))
        for n in (0, 10, 200_000)
    ]
    import gzip
    import os

    os.makedirs(path)
    with open(path + "/a.warc.gz", "wb") as out:
        out.write(b"".join(map(gzip.compress, whole)))
    assert [r.payload_length for r in warc.read_warc(spark, path).collect()] == [0, 10, 200_000]
    lean = warc.read_warc(spark, path, payload="false")
    assert [r.payload_length for r in lean.collect()] == [0, 10, 200_000]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    warc.write_warc(warc.page_records(empty), path)
    assert warc.read_warc(spark, path).count() == 0


# Classifiers


def test_string_kernel_is_what_it_says():
    grams = language_id.Grams(language_id._alphabet(["abc def"]))
    assert len(grams.of("ab, ab")) == len({"a", "b", " ", "ab", "b ", " a", "ab ", "b a", " ab"})
    assert len(grams.of("")) == 0 and len(grams.of("...")) <= 1


def test_languages_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.withColumn("score", F.lit("x")), model)
    tested = found.where(language_id.held_out())
    assert tested.where("lang_pred = lang").count() >= 0.93 * tested.count()
    odd = language_id.identify(frame(spark, ODD), model).collect()
    assert {r.lang_pred for r in odd if r.doc_id in (100, 101, 102, 103)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd)
    none = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(frame(spark, ODD), none).collect()} == {"und"}


def test_toxic_words_are_learnt(spark):
    draw = random.Random(2)
    plain = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(200)]
    rows, marks = [], []
    for i in range(900):
        words = draw.choices(plain, k=60)
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(60)] = draw.choice(["Nasty,", "vile"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = frame(spark, rows + ODD)
    labels = spark.createDataFrame(marks + [(5, 0), (None, 1), (9999, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    assert 0 < len(model.index) < 5000
    scored = toxicity.score(docs, model).join(spark.createDataFrame(marks, "doc_id long, toxic int"), "doc_id")
    tested = scored.where(toxicity.held_out())
    assert tested.where("predicted = toxic").count() >= 0.95 * tested.count()
    odd = toxicity.score(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    empty = toxicity.fit(docs.limit(0), labels)
    assert {r.score for r in toxicity.score(frame(spark, ODD), empty).collect()} == {0.5}


# Quality rules


def brute_repeats(words):
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    hit = [k for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1]
    return len({k + d for k in hit for d in range(3)})


def test_metrics_against_brute_force(spark, texts):
    extra = [(200, "a b c " * 400), (201, "a a a a"), (202, "x y\n\n x y\nx y\nx y"), (203, "|# é\x0b<>&")]
    docs = frame(spark, texts + extra).withColumn("__words", F.lit(3))
    for row in quality_rules.with_metrics(docs).collect():
        text = row.text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), brute_repeats(words),
        )


def test_repeats_when_short_hashes_collide(spark):
    docs = spark.createDataFrame([([5, 7, 5, 9, 7, 1],), ([],), ([1],)], "h array<long>")
    got = docs.select(quality_rules._repeated_places(F.col("h")).alias("p")).collect()
    assert [r.p for r in got] == [[0, 1, 2, 4], [], []]


def test_hosts_that_fail(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good, "fine") for i in range(40)] + [(100 + i, bad, "poor") for i in range(40)]
    rows += [(200, good, "poor"), (201, good, None), (202, None, None), (203, good, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert kept == {*range(40), 201, 203}
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_native_operators_run_no_python(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (quality_rules.judge(docs), chat.format_chats(turns)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# Token files


def test_packing_of_any_width():
    draw = np.random.default_rng(1)
    for bits in (1, 3, 8, 15, 16, 17, 24):
        ids = draw.integers(0, 2**bits, 70_001, dtype=np.uint32)
        assert (token_files.unpack(token_files.pack(ids, bits), len(ids), bits) == ids).all()


@pytest.mark.parametrize("vocabulary", [49_408, 100_000])
def test_token_files_against_the_library(spark, texts, vocabulary):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as source:
        file = source.read()
    library = Tokenizer.from_str(file)
    draw = random.Random(6)
    parts = [*"aAbÉΣ \t\n\x01\x0b\x1c\x85.,'|<>09日́İ", "'s", "<|endoftext|>", "it's5", " \x01 "]
    rows = texts + [(5000 + i, "".join(draw.choices(parts, k=draw.randint(0, 40)))) for i in range(300)]
    files = token_files.write_tokens(
        frame(spark, rows).withColumn("ids", F.lit(1)), shared_path(spark, "test-ids"), file, vocabulary, end=1
    )
    got = token_files.read_tokens(spark, files).collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc_id, start, zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, want)) == sorted(
        repr((r.doc_id, r.start, zlib.crc32(bytes(r.ids)))) for r in got
    )
    with token_files.opened(files.first()["file"]) as source:
        reader = token_files.Reader(source)
        every = reader.ids(0, int(reader.starts[-1]))
        for a, b in ((0, 1), (65_530, 65_540), (70_000, 70_000), (3, 140_000)):
            assert (reader.ids(a, min(b, len(every))) == every[a:b]).all()


def test_special_tokens_in_any_case():
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as source:
        file = source.read()
    library, encoder = Tokenizer.from_str(file), token_files.Encoder(file)
    assert encoder.encode([b"<|EndOfText|>"])[0].tolist() == [27, 347, 40786, 4160, 91, 285]
    draw = random.Random(8)
    parts = ["<|EndOfText|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>",
             "A|B", "Ab", "cD9", "'S", "É", " ", "\n", "<", "|", ">", "EndOfText", "\x01", "\x1c"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(3000)]
    ids, sizes = encoder.encode([t.encode() for t in texts])
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_words_and_their_hashes():
    words = split_words([b"A,b  C\n", b"", b" x" * 50 + b"y" * 900], BARE)
    found = [bytes(words.data[s:e]) for s, e in zip(words.starts, words.ends)]
    assert found == [b"a", b"b", b"c", *[b"x"] * 49, b"x" + b"y" * 900]
    assert words.first.tolist() == [0, 3, 3, 53]
    hashes = hash_spans(words.data, words.starts, words.ends)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(w, 42) for w in found]


def test_templates_that_texts_could_imitate_are_refused():
    for wrong in (
        {"opening": "<|s|>", "after_label": "\n", "closing": "|end|"}, {"closing": ""},
        {"escapes": (("#", "h"), ("<", "l"), (":", "c"))}, {"labels": {"user": "A:B"}},
        {"escapes": (("\\", "e"), ("#", "<"), ("<", "l"), (":", "c"))}, {"labels": {"user": "?"}},
    ):
        with pytest.raises(ValueError):
            chat.Template(**wrong)


def http_record(http, payload, kind="response", crlf=b"\r\n"):
    block = http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:x:1>",
            b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_headers_of_other_archives(spark, tmp_path, packed):
    long = b"HTTP/1.1 200 OK\r\nX: " + b"y" * 9_000 + b"\r\nContent-Length: 5\r\n\r\n"
    plain = b"HTTP/1.1 200 OK\nServer: old\n\n"
    records = [http_record(long, b"hello"), http_record(plain, b"a\r\n\r\nb" * 100_000), http_record(b"HTTP/1.1 204", b"")]
    data = b"".join(gzip.compress(r) if packed else r for r in records)
    (tmp_path / "other.warc").write_bytes(data)
    payloads = [b"hello", b"a\r\n\r\nb" * 100_000, b""]
    for more in ({}, {"payload": "false"}):
        rows = warc.read_warc(spark, str(tmp_path / "other.warc"), **more).collect()
        assert sorted(r.payload_length for r in rows) == sorted(map(len, payloads))
        if not more:
            assert sorted(bytes(r.payload) for r in rows) == sorted(payloads)
