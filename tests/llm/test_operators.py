"""Each operator on small tables with hard rows, against brute force, round trips or held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliate.llm import exact_dedup, htmltext, langid, linededup, media_gif, mixing, neardup, packing, quality, textarrays, tokencount

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta gamma\n" * 20000
HARD = [
    (1, "one two three four five six seven", "en", "a"),
    (2, "one two three four five six seven", "en", "a"),
    (3, "", "en", None),
    (4, None, None, "a"),
    (5, " \t\n", "de", "b"),
    (6, LONG, "en", "b"),
    (7, "x" * 70000, "en", "b"),
    (8, "ünï – cödé 漢字 🙂   end", None, ""),
    (8, "ünï – cödé 漢字 🙂   end", None, ""),
    (None, "no key at all", "fr", "c"),
    (None, None, None, None),
    (9, "<|endoftext|> inside", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns whose names operators use inside.
EXTRA = ["key", "n", "score", "_text", "_key", "_print", "_cuts", "_score", "group", "bucket", "rank", "kept", "size", "removed_chunks", "row"]


@pytest.fixture(scope="module")
def hard(spark):
    df = spark.createDataFrame(HARD, SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in EXTRA})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


def text_of(i):
    return HARD[i][1] or ""


# --- textarrays ------------------------------------------------------------------


def test_word_hashes_cut_blocks_at_words(monkeypatch):
    import pyarrow as pa

    texts = ["Aa bB  cc", None, "", "one", "long" * 50 + " tail", "\tq\n", "aa BB cc"]
    raw, offsets = textarrays.utf8(pa.array(texts))
    whole = textarrays.word_hashes(raw, offsets)
    want = [(i, w.lower()) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    assert whole[1].tolist() == [i for i, _ in want]
    by_word = defaultdict(set)
    for h, (_, w) in zip(whole[0].tolist(), want, strict=True):
        by_word[w].add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)
    monkeypatch.setattr(textarrays, "BLOCK", 7)
    cut = textarrays.word_hashes(raw, offsets)
    assert np.array_equal(cut[0], whole[0]) and np.array_equal(cut[1], whole[1])


# --- 1: GIF --------------------------------------------------------------------------


def lzw_encode(samples, minimum):
    """A plain compressing encoder, for the decoder's sake."""
    clear, out, bits, held = 1 << minimum, bytearray(), 0, 0
    table, width, word = {bytes([i]): i for i in range(clear)}, minimum + 1, b""

    def put(code):
        nonlocal bits, held
        held |= code << bits
        bits += width
        while bits >= 8:
            out.append(held & 255)
            held >>= 8
            bits -= 8

    put(clear)
    size = clear + 2
    for b in samples:
        if word + bytes([b]) in table:
            word += bytes([b])
            continue
        put(table[word])
        if size < 4096:
            table[word + bytes([b])] = size
            size += 1
            if size > 1 << width and width < 12:
                width += 1
        else:
            put(clear)
            table, width, size = {bytes([i]): i for i in range(clear)}, minimum + 1, clear + 2
        word = bytes([b])
    if word:
        put(table[word])
    put(clear + 1)
    if bits:
        out.append(held & 255)
    return bytes(out)


@pytest.mark.parametrize("minimum, seed, size", [(8, 0, 0), (8, 1, 1), (8, 2, 50000), (2, 3, 3000), (8, 4, 9000), (4, 5, 20000)])
def test_lzw_decodes_streams_of_two_encoders(minimum, seed, size):
    rng = np.random.default_rng(seed)
    samples = np.repeat(rng.integers(0, 1 << minimum, size // 3 + 1, dtype=np.uint8), 3)[:size]
    assert np.array_equal(media_gif.lzw_decode(lzw_encode(samples.tobytes(), minimum), minimum, size), samples)
    own = media_gif.lzw_encode(samples.tobytes(), minimum)
    assert np.array_equal(media_gif.lzw_decode(own, minimum, size), samples)
    if size > 1000:
        assert len(own) < len(samples)


def test_frames_apply_palette_transparency_and_disposal():
    def frame(left, top, w, h, index, disposal, clear=None, interlace=False, delay=5):
        flags = disposal << 2 | (clear is not None)
        return b"\x21\xf9\x04" + bytes([flags, delay, 0, clear or 0, 0]) + b"\x2c" + b"".join(v.to_bytes(2, "little") for v in (left, top, w, h)) + bytes([0x40 * interlace, 2]) + media_gif._blocks(lzw_encode(bytes(index), 2))

    head = b"GIF89a\x02\x00\x02\x00\x81\x00\x00" + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    gif = head + frame(0, 0, 2, 2, [1, 1, 1, 1], 1) + frame(0, 0, 2, 1, [2, 0], 3, clear=0) + frame(1, 1, 1, 1, [3], 2) + frame(0, 0, 1, 2, [2, 3], 0, interlace=True) + b";"
    got = [(f.delay_ms, f.canvas[..., :3].tolist(), f.canvas[..., 3].tolist()) for f in media_gif.frames(gif)]
    red, green, blue, none = [255, 0, 0], [0, 255, 0], [0, 0, 255], [0, 0, 0]
    assert [g[0] for g in got] == [50] * 4
    assert got[0][1] == [[red, red], [red, red]]
    assert got[1][1] == [[green, red], [red, red]]
    assert got[2][1] == [[red, red], [red, blue]]  # the frame before was undone
    assert got[3][1] == [[green, red], [blue, none]] and got[3][2] == [[255, 255], [255, 0]]  # the corner was cleared


def test_gif_round_trip(hard, empty):
    got = rows(media_gif.media_digests(media_gif.store_media(hard)))
    assert len(got) == len(HARD)
    want = Counter()
    for i in range(len(HARD)):
        payload = media_gif.padded(text_of(i).encode())
        want[HARD[i][0], len(text_of(i).encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert Counter((g["doc_id"], g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) for g in got) == want
    assert media_gif.store_media(empty).count() == 0
    shown = rows(media_gif.media_frames(media_gif.store_media(hard.where("doc_id = 6"))).select("doc_id", "frame", "shown_at_ms", "histogram"))
    assert [s["shown_at_ms"] for s in shown] == [100 * i for i in range(len(shown))] and all(sum(s["histogram"]) == 3 * 192 * 64 for s in shown[:-1]) and 0 < sum(shown[-1]["histogram"]) <= 3 * 192 * 64


def test_frames_are_transparent_and_disposed_of():
    text = media_gif.padded(b"".join(b"%d lines of text that repeat here and there\n" % (i // 7) for i in range(4000)))
    gif = media_gif.encode(text)
    flags, at = [], 0
    while (at := gif.find(b"\x21\xf9\x04", at)) >= 0:
        flags.append(gif[at + 3])
        at += 8
    assert {f >> 2 & 7 for f in flags} == {1, 2, 3} and {f & 1 for f in flags} == {0, 1}
    assert b"".join(f.canvas[f.top : f.top + f.height, :, 0].tobytes() for f in media_gif.frames(gif)) == text
    assert len(gif) < 0.6 * len(text)
    every = media_gif.padded(bytes(range(256)) * 200)  # no value is free for transparency
    assert b"".join(f.canvas[: f.height, :, 0].tobytes() for f in media_gif.frames(media_gif.encode(every))) == every


def test_null_and_broken_media(spark):
    whole = media_gif.encode(media_gif.padded(b"text"))
    table = spark.createDataFrame([(1, 4, whole), (2, 0, None), (3, 4, whole[:-8]), (4, 4, b"no image"), (None, None, b"")], "doc_id long, n_bytes long, media binary")
    got = {r["doc_id"]: r for r in rows(media_gif.media_digests(table))}
    assert got[1]["payload_bytes"] == 192 and got[1]["frames"] == 1 and got[1]["shown_at_ms"] == [0] and sum(got[1]["histogram"]) == 3 * 192
    assert got[2]["media_bytes"] is None and got[2]["payload_sha256"] is None
    assert all(got[k]["payload_sha256"] is None and got[k]["frames"] is None and got[k]["media_sha256"] for k in (3, 4, None))
    assert {r["doc_id"] for r in rows(media_gif.media_frames(table))} == {1}


# --- 2: packing ----------------------------------------------------------------------


def check_packing(got, texts, capacity):
    encode = tokencount.encoder("byte_bpe_50k.json")
    ids = {k: np.append(encode(t or ""), 1).astype("<u4") for k, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for g in got:
        by_doc[g["doc_row"]].append(g)
        by_sequence[g["sequence_id"]].append(g)
        own = ids[g["doc_id"]]
        assert g["doc_tokens"] == len(own) and zlib.crc32(own[g["start"] : g["start"] + g["length"]].tobytes()) == g["ids_crc32"]
    for parts in by_doc.values():
        assert sorted(x for p in parts for x in range(p["start"], p["start"] + p["length"])) == list(range(parts[0]["doc_tokens"]))
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda x: x["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return sum(sum(p["length"] for p in s) for s in by_sequence.values()) / (capacity * len(by_sequence))


def test_packing_places_every_id_once(docs):
    texts = {r["doc_id"]: r["text"] for r in rows(docs.select("doc_id", "text"))}
    assert check_packing(rows(packing.pack(docs)), texts, 2048) > 0.97
    assert check_packing(rows(packing.pack(docs, capacity=100, piece=40, group_pieces=50)), texts, 100) > 0.9


def test_packing_of_hard_rows(hard, empty):
    got = rows(packing.pack(hard.where("doc_id is not null or text is not null")))
    texts = {k: t for k, t, *_ in HARD}
    texts[None] = "no key at all"
    check_packing(got, texts, 2048)
    assert len({g["doc_row"] for g in got}) == len(HARD) - 1
    assert packing.pack(empty).count() == 0


def test_differencing_balances_and_grows():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 500, 400)
    window, sums = packing.difference(lengths, 40)
    assert sums.sum() == lengths.sum() and sums.max() - sums.min() <= 30
    assert np.array_equal(np.bincount(window, lengths, 40), sums)
    tight = packing.pack_group(np.array([60, 60, 60, 100]), 100)
    assert len(set(tight.tolist())) == 4


# --- 3: language -------------------------------------------------------------------------


def test_language_on_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in rows(langid.op3_language_id(spark, DATA))}
    truth = {r["doc_id"]: r["lang"] for r in rows(docs.select("doc_id", "lang"))}
    held = [k for k, r in got.items() if r["held_out"]]
    assert len(got) == len(truth) and held and all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert np.mean([got[k]["lang_pred"] == truth[k] for k in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_hard_rows(spark, hard, docs, empty):
    model = langid.fit(docs)
    got = rows(langid.predict(hard, model))
    assert len(got) == len(HARD)
    assert all(g["lang_pred"] == "und" and g["score"] == 0 for g in got if g["doc_id"] in (3, 4, 5))
    assert {g["lang_pred"] for g in got} - {"und"} <= set(model.langs)
    none = langid.fit(empty)
    assert {g["lang_pred"] for g in rows(langid.predict(hard, none))} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_small_languages_have_their_own_words(spark):
    """A language with few documents keeps its words beside a large one, and copies don't fill the sample."""
    rng = np.random.default_rng(4)
    texts = [("big", " ".join(f"qa{x}" for x in rng.integers(100, 400, 30))) for _ in range(300)] + [("big", "qa100 " * 30)] * 300 + [("small", "zu" + " zu".join("abcdef"))] * 3
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    model = langid.fit(df, max_train=100, max_words=40, max_grams=200)
    assert model.score("zua zub zuc")[0] == "small" and model.score("zuq zur")[0] == "small" and model.score("qa200 qa999")[0] == "big"
    assert langid.Model([], [], []).score("any")[0] == "und"


def test_unseen_words_back_off():
    model = langid.Model(["a", "b"], [("xx", "a", 9), ("yy", "b", 9)], [("<qu", "a", 9), ("<qu", "b", 1), ("u", "b", 9), ("u", "a", 9)])
    assert model.score("xx")[0] == "a" and model.score("quz")[0] == "a" and model.score("yy quz yy")[0] == "b"
    assert model.score("123 !")[0] == "und"


def plain_language(train, texts, max_words, max_grams, longest=4):
    """The language of each text by dictionaries alone."""
    split = lambda t: re.findall(r"(?:[a-z]|[^\x00-\x7f])+", t.lower())
    grams_of = lambda w, k: [f"<{w}>"[i : i + k] for i in range(len(w) + 3 - k)]
    langs, counts = sorted({lang for lang, _ in train}), defaultdict(Counter)
    for lang, text in train:
        counts[lang].update(split(text))

    def table(of, most):
        kept = {}
        for lang in langs:
            for e, n in sorted(of[lang].items(), key=lambda x: (-x[1], x[0]))[:most]:
                kept.setdefault(e, {})[lang] = n
        return kept

    every = {lang: Counter() for lang in langs}
    for lang in langs:
        for w, n in counts[lang].items():
            for k in range(1, longest + 1):
                for g in grams_of(w, k):
                    every[lang][g] += n
    words, grams = table(counts, max_words), table(every, max_grams)

    def logs(kept):
        total = {lang: sum(x.get(lang, 0) for x in kept.values()) + 0.5 * max(1, len(kept)) for lang in langs}
        return {e: [np.log((x.get(lang, 0) + 0.5) / total[lang]) for lang in langs] for e, x in kept.items()}

    words = logs(words)
    grams = {k: logs({g: x for g, x in grams.items() if len(g) == k}) for k in range(1, longest + 1)}
    out = []
    for text in texts:
        total, found = np.zeros(len(langs)), split(text)
        for w in found:
            if w in words:
                total += words[w]
                continue
            for k in range(longest, 0, -1):
                known = [grams[k][g] for g in grams_of(w, k) if g in grams[k]]
                if known:
                    total += np.mean(known, axis=0)
                    break
        odds = np.exp((total - total.max()) / len(found) ** 0.5)
        out.append((langs[int(odds.argmax())], odds.max() / odds.sum()))
    return out


def test_language_scores_equal_plain_python(spark, docs):
    train = docs.where("lang is not null and text is not null and doc_id % 3 = 0")
    texts = [(r.doc_id, r.text) for r in docs.where("text is not null and length(text) < 4000").collect() if re.search(r"[a-zA-Z]", r.text)]
    got = {r["doc_id"]: r for r in rows(langid.predict(docs, langid.fit(train, max_words=60, max_grams=300)))}
    want = plain_language([(r.lang, r.text) for r in train.collect()], [t for _, t in texts], 60, 300)
    for (key, _), (lang, odds) in zip(texts, want, strict=True):
        assert abs(got[key]["score"] - odds) < 1e-9 and (got[key]["lang_pred"] == lang or odds < 0.51)


def test_sixty_languages(spark):
    """The model grows with the languages, each with its own words; unseen words are told by their letters."""
    rng = np.random.default_rng(9)
    stems = [[f"{a}{b}" for a in rng.permutation(list("bcdfgklmnp"))[:3] for b in rng.permutation(list("aeiou"))[:3]] for _ in range(60)]
    draw = lambda k: " ".join(f"l{k:02d}"[1:].translate({48 + i: c for i, c in enumerate("qwrtyzhjvx")}) + "".join(rng.choice(stems[k], 2)) for _ in range(25))
    df = spark.createDataFrame([(i, f"lang{i % 60:02d}", draw(i % 60)) for i in range(1200)], "doc_id long, lang string, text string")
    model = langid.fit(df, max_train=15, max_words=20, max_grams=60)
    assert len(model.langs) == 60 and len(model.words.held) <= 60 * 20 and sum(len(t.held) for t in model.grams.values()) <= 60 * 60
    got = rows(langid.predict(df, model).join(df.select("doc_id", "lang"), "doc_id"))
    assert np.mean([g["lang_pred"] == g["lang"] for g in got]) > 0.95


# --- 4: mixing -------------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in capped}, **share, **target}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, None: 5, "": 0}, {"a": 100}, {"a": 0}, {"x": 3, "y": 1, "z": 900, "w": 2, "v": 50}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5), F.lit(2)).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_mix_comes_near_its_targets(docs):
    got = rows(mixing.mix_sources(docs))
    texts = {r["doc_id"]: r["text"] for r in rows(docs.select("doc_id", "text"))}
    assert all(g["size"] == len(WORD.findall(texts[g["doc_id"]] or "")) and g["taken"] <= 3 * g["size"] for g in got)
    taken, target = defaultdict(int), {}
    for g in got:
        taken[g["source"]] += g["taken"]
        target[g["source"]] = g["target"]
    assert all(abs(taken[s] - target[s]) <= 3 * mixing.BLOCK_WORDS for s in target)
    assert sorted(map(str, got)) == sorted(map(str, rows(mixing.mix_sources(docs.repartition(3)))))
    mixed = defaultdict(int)
    for r in rows(mixing.mixed_documents(docs)):
        mixed[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert mixed == {g["doc_id"]: g["taken"] for g in got if g["taken"]}


def test_mixed_documents_hold_the_blocks_read(docs):
    texts = {r["doc_id"]: (r["text"] or "").lstrip(" \t\n\x0b\x0c\r") for r in rows(docs.select("doc_id", "text"))}
    _, _, reads = mixing._read_blocks(docs, "text", "doc_id", "source", {})
    want = defaultdict(list)
    for r in sorted(rows(reads), key=lambda r: r["start"]):
        want[r["doc_id"], r["begin"], r["pass"]].append(range(r["start"], r["start"] + r["words"]))
    spans = {i: [m.start() for m in WORD.finditer(t)] + [len(t)] for i, t in texts.items()}
    made = Counter((i, "".join(texts[i][spans[i][a.start] : spans[i][a.stop]] for a in parts)) for (i, _, _), parts in want.items())
    assert Counter((r["doc_id"], r["text"].lstrip(" \t\n\x0b\x0c\r")) for r in rows(mixing.mixed_documents(docs))) == made


def test_slots_fill_many_tasks_and_shards_hold_every_source(spark):
    sizes = spark.createDataFrame([("a", 30_000_000), ("b", 3_000_000), ("c", 3_000_000)], "source string, source_size long")
    made = mixing.slots(mixing.targets(sizes), shard_slots=4096).withColumn("task", F.spark_partition_id())
    by_task = [r["count"] for r in made.groupBy("task").count().collect()]
    assert len(by_task) > 4 and max(by_task) < 0.5 * sum(by_task)
    share = {r["rank"]: r["target"] / 36_000_000 for r in mixing.targets(sizes).collect()}
    counts = [r for r in made.groupBy("shard", "rank").count().collect() if r["shard"] < sum(by_task) // 4096]
    drawn = {k: np.array([r["count"] for r in counts if r["rank"] == k]) for k in share}
    for k, p in share.items():  # mean and spread of a multinomial draw
        assert abs(drawn[k].mean() - 4096 * p) < 10 and 0.7 < drawn[k].std() / (4096 * p * (1 - p)) ** 0.5 < 1.3
    assert made.groupBy("rank", "pass", "block").count().where("count > 1").isEmpty()


def test_mix_of_hard_rows(hard, empty):
    got = rows(mixing.mix_sources(hard, block_words=8))
    assert len(got) == len(HARD)
    assert all(g["taken"] == 0 for g in got if g["doc_id"] in (3, 4, 5))
    assert mixing.mix_sources(empty).count() == 0
    out = mixing.mixed_documents(hard, block_words=8)
    assert set(out.columns) == set(hard.columns) and out.where("text is null").count() == 0


# --- 5: token counts -------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_token_counts_are_the_librarys(hard, empty, name):
    import sentencepiece
    from tokenizers import Tokenizer

    path = tokencount.vocabulary(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(text_of(i))) for i in range(len(HARD))]
    else:
        model = Tokenizer.from_file(path)
        want = [len(model.encode(text_of(i), add_special_tokens=False).ids) for i in range(len(HARD))]
    got = rows(tokencount.token_counts(hard, name=name))
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted(((g["doc_id"], g["n_bytes"], g["n_tokens"], g["over_limit"]) for g in got), key=key) == sorted(((HARD[i][0], len(text_of(i).encode()), n, n > 1024) for i, n in enumerate(want)), key=key)
    assert tokencount.token_counts(empty, name=name).count() == 0


def test_fast_encoder_agrees_on_common_characters():
    from tokenizers import Tokenizer

    own, encode = Tokenizer.from_file(tokencount.vocabulary()), tokencount.encoder("byte_bpe_50k.json")
    rng = np.random.default_rng(3)
    ranges = ((0, 0x2B0), (0x300, 0x370), (0x2010, 0x2028), (0x2030, 0x205F), (0x20A0, 0x20C0))
    alphabet = [chr(c) for a, b in ranges for c in range(a, b)] + [" "] * 300 + ["a", "'s", "\n", "1"] * 60
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, rng.integers(1, 25)))
        assert encode(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_pieces_keep_the_tokens():
    encode = tokencount.encoder("byte_bpe_50k.json")
    text = "Some words,  and\n more of it's kind 12 " * 9
    parts = list(tokencount.pieces(text, 40))
    assert len(parts) > 3 and "".join(parts) == text
    assert [i for p in parts for i in encode(p).tolist()] == encode(text).tolist()
    for text in ("ひらがな漢字、カタカナ。한국어！" * 30, "a\tb\n\n c\r\n <|endoftext|> d" * 30, "<|endoftext|>" * 60):
        parts = list(tokencount.pieces(text, 40))
        assert "".join(parts) == text and (len(parts) > 3) == (text[0] != "<")
        assert [i for p in parts for i in encode(p).tolist()] == encode(text).tolist()


#: Texts that are one run of a character, or hold one between words.
RUNS = [" " * 1_200_000, "\n" * 1_200_000, "\t" * 1_200_000, "x" * 1_200_000, "word " + " " * 1_100_000 + "word", "漢" * 300_000, "." * 1_200_000, " \n" * 600_000]


def test_long_runs_are_encoded(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokencount.vocabulary())
    want = [own.encode(t, add_special_tokens=False).ids for t in RUNS]
    table = spark.createDataFrame(list(enumerate(RUNS)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in rows(tokencount.token_counts(table))} == {i: len(ids) for i, ids in enumerate(want)}
    for r in rows(packing.pack(table)):
        ids = [*want[r["doc_id"]], packing.END_ID]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())


def test_millions_of_blanks_are_encoded():
    from tokenizers import Tokenizer

    text = " " * 5_000_000
    assert len(tokencount.token_ids("byte_bpe_50k.json")(text)) == len(Tokenizer.from_file(tokencount.vocabulary()).encode(text, add_special_tokens=False).ids)


def test_packing_leaves_other_vocabularies_whole(spark):
    import sentencepiece

    text = "some words of no meaning " * 4000
    want = sentencepiece.SentencePieceProcessor(model_file=tokencount.vocabulary("piece_bpe_32k.model")).encode(text)
    got = rows(packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), name="piece_bpe_32k.model"))
    assert got[0]["doc_tokens"] == len(want) + 1


# --- 6: quality ------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    big = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows(quality.op6_quality(spark, big))}
    labels = {r["doc_id"]: r["quality"] for r in rows(spark.read.parquet(f"{big}/labels.parquet"))}
    held = [k for k in labels if got[k]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for k, r in got.items())
    assert np.mean([got[k]["predicted"] == labels[k] for k in held]) >= 0.95


def test_quality_of_hard_rows(spark, hard, docs, empty):
    model = quality.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    got = rows(quality.score(hard, model))
    assert len(got) == len(HARD) and all(0 <= g["score"] <= 1 for g in got)
    kept = quality.score(hard, model, keep=True)
    assert kept.columns == ["row", "score"] and kept.select("row.*").columns == hard.columns and kept.count() == len(HARD)
    assert quality.score(empty, model).count() == 0
    same = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    flat = rows(quality.score(hard, quality.fit(hard, same)))
    assert len({round(g["score"], 6) for g in flat}) == 1


def test_attention_gradient():
    rng = np.random.default_rng(0)
    features, first = rng.normal(size=(9, quality.FEATURES)).astype(np.float32), np.array([0, 2, 3, 9])
    model = quality.Attention(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), 0.0)
    labels = np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(labels * np.log(model.score(features, first)) + (1 - labels) * np.log(1 - model.score(features, first)))
    before = loss()
    model.train(features, first, labels)
    assert loss() < before / 10


# --- 7: pages -------------------------------------------------------------------------------------------


def article(page):
    import html

    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<(?:b|br)>|</b>", " ", x))).strip() for x in re.split(r"</?(?:h1|p)>", inner)]
    return "\n".join(p for p in parts if p)


def test_pages_give_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in rows(spark.read.parquet(f"{DATA}/pages.parquet"))}
    got = {r["page_id"]: r for r in rows(htmltext.op7_html_text(spark, DATA))}
    assert {k: r["text"] for k, r in got.items()} == {k: article(p) for k, p in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_repeated_runs_are_boilerplate_only_on_their_host(spark, empty):
    shared = "<div>A notice that every page of this host repeats word for word</div>"
    pages = [
        (1, "http://a.org/1", f"<body>{shared}<p>own one<p>q &amp; a</p></body>"),
        (2, "http://A.org/2", f"<body>{shared}<div>seven words in</div><div>three short blocks</div><div>repeat</div><p>own two</p></body>"),
        (3, "https://a.org:80/3", "<body><div>seven words in</div><div>three short blocks</div><div>repeat</div><div>seven words in</div><p>own three</p></body>"),
        (4, "http://b.org/", f"{shared}<script>if (a < b) {{}}</script><ul><li>x<li>y</ul>"),
        (5, "http://a.org/5", f"<nav>menu</nav><main><h1>T</h1>{shared}<form>f</form><aside>s</aside></main><div class='user-comments'>c</div>"),
        (6, None, None),
        (6, "odd", ""),
        (7, "http://c.org", "text <b>bold</b> and <i>more</i>\n\n lines <!-- gone --> &lt;p&gt; <"),
        (None, "http://d.org", "<p>unclosed <a href='x>y'>link</a> <style>p{}</style>end"),
        (8, "http://b.org/8", "<p>a copy of a page erases nothing of its twin at all</p>"),
        (9, "http://b.org/9", "<p>a copy of a page erases nothing of its twin at all</p>"),
        (10, "http://b.org/10", "<p>first: words of a long passage that two pages of a host quote, and more</p>"),
        (11, "http://b.org/11", "<p>other: words of a long passage that two pages of a host quote; an end</p>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("page", "id", "blocks", "host", "group")})
    want = [
        (1, "own one\nq & a"), (2, "own two"), (3, "seven words in\nown three"), (4, "A notice that every page of this host repeats word for word\nx\ny"),
        (5, "T\nA notice that every page of this host repeats word for word"), (6, ""), (6, ""), (7, "text bold and more lines <p> <"), (0, "unclosed link end"),
        (8, pages[9][2][3:-4]), (9, pages[9][2][3:-4]), (10, "first: quote, and more"), (11, "other: quote; an end"),
    ]
    for size in (60, 300, 1 << 20):
        got = sorted(((r["page_id"] or 0, r["text"]) for r in rows(htmltext.main_text(df, shard_bytes=size))), key=str)
        assert got == sorted(want, key=str)
    assert htmltext.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_article_text_is_kept():
    stay = lambda page: "\n".join(t for z, t in htmltext.blocks(page) if z in (htmltext.MAIN, htmltext.OPEN, htmltext.NOMINATED))
    assert stay("<article><p>x <span class='share'>y</span> z</p><p>w</p></article>") == "x z\nw"
    assert stay("<article><p>x <span class='share'>y<span>v</span>y</span> z <a class='nav-link'>u</a></p></article>") == "x z u"
    assert stay("<article><div class='related-work'>a</div><section id='search'>b</section><ul class='menu-items'><li>c</ul>d</article>") == "a\nb\nc\nd"
    assert stay("<article>a<div class='comments'><article>c</article></div><div class=ad>d</div><form>f</form></article>") == "a"
    assert stay("<form><div class='page-with-sidebar'><main>a</main>b</div></form><div class='no-sidebar'>c</div>") == "a\nc"
    assert stay("<p title=it's>a</p><p>b's</p>") == "a\nb's"


@pytest.mark.parametrize("unit", ["<a href='x ", "<a ", "<div><a href=\"", "<!", "</", "<p>a</q>", "<script ", "</script ", "&", "<a b='>'c ", "<div class='ad ", "<span class=ad>", "<a =  "])
@pytest.mark.parametrize("end", ["", ">", "'", "\">x"])
def test_broken_pages_are_read_once(unit, end):
    import time

    page = unit * (1_000_000 // len(unit)) + end
    began = time.process_time()
    htmltext.blocks(page)
    assert time.process_time() - began < 4


def test_one_host_fills_many_tasks(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "'http://one.org/' || id AS url", "'<p>' || repeat('word ' || id || ' ', 30) || '</p>' AS html")
    parsed, large = htmltext.dealt_pages(pages, "page_id", "url", "html", 4096)
    tasks = parsed.repartition(32, "group").groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert large and len(tasks) > 24 and max(r["count"] for r in tasks) < 400


def test_suffix_array_by_brute_force():
    rng = np.random.default_rng(2)
    for depth, kinds in ((1, 3), (3, 3), (8, 2), (16, 1)):
        tokens = rng.integers(0, kinds, 60).astype(np.uint64)
        order, common = htmltext.suffix_array(tokens, depth)
        prefix = [tokens[i : i + depth].tolist() for i in order]
        assert sorted(order) == list(range(60)) and prefix == sorted(prefix)
        for k, (i, j) in enumerate(zip(order[:-1], order[1:], strict=True)):
            same = next((n for n in range(60) if max(i, j) + n >= 60 or tokens[i + n] != tokens[j + n]))
            assert min(same, depth) == min(common[k], depth)


def test_repeats_by_brute_force(spark):
    """With the guard off: the words of a page that no run of tokens shared with another page covers."""
    rng = np.random.default_rng(5)
    menus = [" ".join(f"m{i}{k}" for k in range(12)) for i in range(3)]
    made = []
    for i in range(60):
        body = " ".join(f"w{x}" for x in rng.integers(0, 60, 40))
        made.append((i, f"http://h{i % 2}.org/{i}", [menus[rng.integers(3)], body, menus[rng.integers(3)]]))
    pages = spark.createDataFrame([(i, u, "".join(f"<p>{b}</p>" for b in blocks)) for i, u, blocks in made], "page_id long, url string, html string")
    run, want = 5, {}
    streams = {i: [(w, k) for k, b in enumerate(blocks) for w in [*b.split(), "|"]] for i, _, blocks in made}
    seen = defaultdict(set)
    for i, s in streams.items():
        for at in range(len(s) - run + 1):
            seen[i % 2, tuple(w for w, _ in s[at : at + run])].add(i)
    for i, s in streams.items():
        gone = {q for at in range(len(s) - run + 1) if len(seen[i % 2, tuple(w for w, _ in s[at : at + run])]) > 1 for q in range(at, at + run)}
        kept = [" ".join(w for q, (w, b) in enumerate(s) if b == k and w != "|" and q not in gone) for k in range(3)]
        want[i] = "\n".join(x for x in kept if x)
    for size in (2000, 1 << 20):
        assert {r["page_id"]: r["text"] for r in rows(htmltext.main_text(pages, shard_bytes=size, min_run=run, guard=False))} == want


# --- 8: exact duplicates -----------------------------------------------------------------------------------


def duck(docs_path, sql):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{docs_path}/documents.parquet'")
    result = con.sql(sql)
    return Counter(tuple(sorted(zip(result.columns, r, strict=True))) for r in result.fetchall())


def test_exact_groups_agree_with_sql(spark):
    got = Counter(tuple(sorted(r.items())) for r in rows(exact_dedup.op8_exact_dedup(spark, DATA)))
    assert got == duck(DATA, exact_dedup.ORACLE)


def test_exact_groups_of_hard_rows(hard, empty):
    got = rows(exact_dedup.exact_groups(hard))
    by = defaultdict(list)
    for k, t, *_ in HARD:
        by[t or ""].append(k)
    want = Counter((k, max((x for x in ks if x is not None), default=None), len(ks), hashlib.sha256(t.encode()).hexdigest()) for t, ks in by.items() for k in ks)
    assert Counter((g["doc_id"], g["keep_id"], g["group_size"], g["text_sha256"]) for g in got) == want
    assert all(g["kept"] == (g["doc_id"] == g["keep_id"]) for g in got)
    assert exact_dedup.exact_groups(empty).count() == 0
    prefix = exact_dedup.exact_groups(hard.where("doc_id is not null"), prefix_chars=1, normalise=F.upper)
    assert prefix.where("group_size > 1").count() == 6


# --- 9: near duplicates -------------------------------------------------------------------------------------


def shingles(text, words):
    w = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    return frozenset(zip(*(w[i:] for i in range(words)))) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute_components(pairs, words):
    sets = [(k, shingles(t, words)) for k, t in pairs]
    parent = {k: k for k, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= 80 * (len(s) + len(t) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(s), root(k)) for k, s in sets}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_by_brute_force(docs, words):
    pairs = [(r["doc_id"], r["text"]) for r in rows(docs.select("doc_id", "text"))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(docs, words=words))}
    assert got == brute_components(pairs, words)


def test_clouds_of_copies_keep_all_their_links(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(90):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 14)), replace=False):
            words[at] = f"e{k}x{at}"
        texts.append((k + 1, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute_components(texts, 2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(df, words=2))} == want
    monkeypatch.setattr(neardup, "GROUP_ROWS", 5)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 700)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(df, words=2))} == want


def family(n, template=200, own=45, seed=1):
    """Texts that share most of a template and are not similar enough to be linked."""
    rng = np.random.default_rng(seed)
    for k in range(n):
        words = [f"t{i}" for i in range(template)]
        for at in rng.choice(template, own, replace=False):
            words[at] = f"own{k}x{at}"
        yield k + 1, " ".join(words)


def test_families_of_unlike_texts_leave_nothing_to_compare(spark, monkeypatch):
    texts = [*family(600), (9001, "t1 t2 t3 own lines"), (9002, "t1 t2 t3 own lines")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    left, active = [], neardup._active
    monkeypatch.setattr(neardup, "_active", lambda r, s: left.append((r.count(), (a := active(r, s)).count())) or a)
    got = {r["doc_id"]: r["component_id"] for r in rows(neardup.near_duplicates(df, words=2))}
    assert got == {k: k if k != 9002 else 9001 for k, _ in texts}
    assert left[0][0] > 400 and left[0][1] < 30


def test_links_across_components_of_one_family(spark):
    """Texts drawn from one vocabulary, so that all meet, with near copies of some under no common head's component."""
    rng = np.random.default_rng(8)
    texts = []
    for k in range(60):
        words = [f"u{i}" for i in sorted(rng.choice(90, 70, replace=False))]
        texts.append((3 * k + 1, " ".join(words)))
        for copy in range(int(rng.integers(0, 3))):
            near = list(words)
            near[int(rng.integers(70))] = f"new{k}{copy}"
            texts.append((3 * k + 2 + copy, " ".join(near)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for words in (1, 2):
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(df, words=words))} == brute_components(texts, words)


def test_keys_repeated_with_other_texts_have_the_links_of_all(spark):
    one, two = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    df = spark.createDataFrame([(5, one), (5, two), (6, one + " more"), (7, two + " more"), (8, "alone")], "doc_id long, text string")
    want = sorted([(5, 5), (5, 5), (6, 5), (7, 5), (8, 8)])
    for table in (df, df.orderBy(F.desc("text")).coalesce(1)):
        assert sorted((r["doc_id"], r["component_id"]) for r in rows(neardup.near_duplicates(table))) == want


def test_near_duplicates_of_hard_rows(hard, empty):
    got = rows(neardup.near_duplicates(hard))
    assert len(got) == len(HARD)
    assert {(g["doc_id"], g["component_id"]) for g in got if g["doc_id"] in (1, 2, 3, 4, 5)} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)}
    assert all(g["component_id"] is None and g["kept"] for g in got if g["doc_id"] is None)
    assert neardup.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in rows(neardup.components(links))}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100} or got == {**{i: 1 for i in range(2, 41)}, 101: 100}


# --- 10: line chunks ------------------------------------------------------------------------------------------


def test_line_dedup_agrees_with_sql(spark):
    got = Counter(tuple(sorted(r.items())) for r in rows(linededup.op10_line_dedup(spark, DATA)))
    want = duck(DATA, linededup.ORACLE)
    assert sum(got.values()) == sum(want.values()) and got == want


def test_chunks_move_with_their_lines(spark, empty):
    passage = "\n".join(f"shared line {i} of a passage" for i in range(30))
    texts = [(1, f"a\n{passage}\nz"), (2, f"b\nc\nd\n{passage}"), (3, "only this"), (4, None), (5, ""), (6, "\n\n\n"), (7, "\n\n\n"), (7, "\n\n\n"), (None, passage)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("extra") for c in EXTRA})
    got = {(r["doc_id"], r["text"]): r for r in rows(linededup.dedup_lines(df))}
    by = {k: t for k, t in got}
    assert by[1] == texts[0][1] and by[3] == "only this" and by[4] is None and by[5] == "" and by[6] == by[7] == "\n\n\n"
    # chunks of one line stay, and so may the passage's edges; everything between is gone in both
    for k, own in ((2, ["b", "c", "d"]), (None, [])):
        left = by[k].split("\n")
        assert left[: len(own)] == own and len(left) - len(own) <= 15 and all(a in passage.split("\n") for a in left[len(own) :])
    assert linededup.dedup_lines(empty).count() == 0


def test_no_line_of_a_passage_stays_twice(spark, docs):
    """Lines of over 50 words are passages themselves: each stays once, whatever stands beside it."""
    long = lambda t: [x for x in (t or "").split("\n") if len(re.findall(r"\S+", x, re.A)) > 50]
    before = Counter(x for r in docs.collect() for x in long(r["text"]))
    after = Counter(x for r in rows(linededup.op10_line_dedup(spark, DATA)) for x in long(r["text"]))
    assert max(before.values()) > 1 and after.keys() == before.keys() and set(after.values()) == {1}
    line = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, f"a\n{line}\nb"), (2, f"c\n{line}\n{line}"), (3, line), (4, line[:200])], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df).collect()} == {1: f"a\n{line}\nb", 2: "c", 3: "", 4: line[:200]}


def chunk_spans(text):
    """(first line, last line) of each chunk of at least two lines, not all blank."""
    lines = text.split("\n")
    digests, begin = [hashlib.md5(x.encode()).hexdigest() for x in lines], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or hashlib.md5("".join(digests[max(i - 1, 0) : i + 1]).encode()).hexdigest()[0] < "8":
            if i > begin and "".join(lines[begin : i + 1]).strip():
                yield begin, i
            begin = i + 1


def standing_earlier(texts, most=linededup.MOST_WORDS):
    """(key, line) of the lines in runs of over ``most`` words, or in chunks, that stand at an earlier place."""
    seen, gone = set(), set()
    for k, t in texts:
        lines = t.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        weight = {i: max(len(re.findall(r"\S+", lines[i], re.A)), -(-len(lines[i]) // linededup.LONG_WORD)) for i in full}
        runs = [(full[b], full[e], tuple(lines[i] for i in full[b : e + 1])) for b in range(len(full)) for e in range(b, len(full)) if sum(weight[i] for i in full[b : e + 1]) > most]
        for b, e, run in runs + [(b, e, "\n".join(lines[b : e + 1])) for b, e in chunk_spans(t)]:
            if run in seen:
                gone |= {(k, i) for i in range(b, e + 1)}
            seen.add(run)
    return gone


def test_planted_passages_go_whole(spark, empty):
    sizes = (1, 2, 3, 5, 30)
    words = lambda tag, n: " ".join(f"{tag}w{j}" for j in range(n))
    planted = {n: "\n".join(words(f"p{n}l{i}", 60 // n + 1) for i in range(n)) for n in sizes}
    texts = [(n, f"own {n}\n{planted[n]}\nend {n}") for n in sizes] + [(100 + n, f"other {n}\nmore\n{planted[n]}\nlast {n}") for n in sizes]
    texts += [(200, "\n\n".join(planted[5].split("\n"))), (201, words("p1l0", 20)), (202, "own 1"), (203, "\n".join(["again " * 20] * 9))]
    texts += [(204, "\n".join(planted[30].split("\n")[9:29]) + "\nnew")]
    df = spark.createDataFrame([*texts, (205, None), (206, ""), (None, planted[2])], "doc_id long, text string").withColumns({c: F.lit("extra") for c in EXTRA})
    out = linededup.dedup_passages(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[205] is None and got[206] == "" and got[None] == "" and got[200] == "" and got[204] == "new"
    assert all(got[100 + n] == f"other {n}\nmore\nlast {n}" for n in sizes)
    gone = standing_earlier(texts)
    assert all(got[k] == "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone) for k, t in texts)
    assert linededup.dedup_passages(empty).count() == 0


def test_passages_of_the_given_tables(spark, docs):
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    short = [(k, t) for k, t in texts if t.count("\n") < 60]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_passages(docs.where(F.col("doc_id").isin([k for k, _ in short]))).collect()}
    gone = standing_earlier(short)
    assert gone and all((got[k] or "") == "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone) for k, t in short)


def test_line_stage_leaves_no_planted_passage(spark):
    import corpus_pipeline

    planted = {n: "\n".join(" ".join(f"s{n}l{i}w{j}" for j in range(60 // n + 1)) for i in range(n)) for n in (1, 2, 3, 5, 30)}
    texts = [(n, f"own {n}\n{p}") for n, p in planted.items()] + [(100 + n, f"other {n}\n{p}") for n, p in planted.items()]
    df = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.line_stage(spark, df, DATA).collect()}
    assert got == {k: (t, len(t)) for k, t in ((k, t if k < 100 else f"other {k - 100}") for k, t in texts)}


# --- pipeline: the other stages ---------------------------------------------------------------------------------


def test_near_stage_against_brute_force(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(200)]
    texts = {1: " ".join(base), 2: " ".join(base), 3: " ".join([*base[:199], "other"]), 4: " ".join(f"v{i}" for i in range(200)), 5: " ".join(base[:100]), 6: "", 7: None}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, (t or "").split()) for k, t in texts.items())}
    copies = {b for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert copies == {2, 3}
    df = spark.createDataFrame([*texts.items(), (None, texts[1]), (None, texts[1])], "doc_id long, text string").withColumns({c: F.lit("extra") for c in EXTRA})
    out = corpus_pipeline.near_stage(spark, df, DATA)
    assert out.columns == df.columns
    want = Counter((k, t) for k, t in texts.items() if k not in copies) + Counter({(None, texts[1]): 2})
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want


def test_mixing_stage_returns_the_words_of_its_documents(spark, docs):
    import corpus_pipeline

    given = {r["doc_id"]: WORD.findall(r["text"] or "") for r in docs.collect()}
    got = rows(corpus_pipeline.mixing_stage(spark, docs, DATA))
    part = 0
    for r in got:
        words = WORD.findall(r["text"])
        assert r["n_chars"] == len(r["text"]) and not Counter(words) - Counter(given[r["doc_id"]])
        part += len(words) < len(given[r["doc_id"]])
    assert part > 0


def test_run_chains_every_stage(spark, docs):
    import corpus_pipeline

    step = docs
    for name, stage in corpus_pipeline.STAGES:
        step = corpus_pipeline.durable(stage(spark, step, DATA), name)
    want = Counter(map(str, step.collect()))
    assert want and Counter(map(str, corpus_pipeline.run(spark, DATA).collect())) == want
