"""Corpus operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from tessera.llm import bpe, decontaminate, langid, passages, pii, quality, simhash, suffixes, urls, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that it was for on as with by at from this are an be río schön été".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ly", "ing", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(30, 160)), rng.choice(["en", "fr", None]), "s", None) for i in range(60)]
    base = prose(rng, 120)
    rows += [(100 + k, base if k % 2 else base.replace("the", "a", 1), "en", "s", 1) for k in range(6)]
    passage = prose(rng, 70)
    rows += [(200 + k, prose(rng, 20) + " " + passage + " " + prose(rng, 20), None, None, None) for k in range(4)]
    rows += [(300, None, "en", "s", 0), (301, "", "en", "s", 0), (302, " \n\t ", None, "s", 3), (303, "...", "en", "s", 3), (304, "one two", "fr", "s", 7)]
    rows += [(305, prose(rng, 6000), "en", "s", None), (100, base, "en", "s", 1), (None, base, "en", "s", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


def odd(df):
    """The table with columns that have the names operators use inside."""
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(("row", "w", "t", "tri", "fp", "_rid", "_fp", "bid", "r", "blob", "kept", "key", "first", "low", "idx", "spans", "rule"))))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    for out in (
        simhash.near_components(empty), simhash.drop_near_copies(empty), bpe.bpe_digests(empty, path), urls.judge_urls(pages), decontaminate.find_leaks(empty, bench), pii.find_personal_data(empty),
        langid.identify(empty, langid.fit(empty, F.lit(True))), suffixes.remove_repeats(empty), warc.records(warc.archives(pages)), quality.judge_quality(empty), quality.keep_quality(empty), passages.near_duplicate_passages(empty),
    ):
        assert out.count() == 0


def brute_simhash(corpus):
    prints = []
    for i, t, *_ in corpus:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        grams = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    root = {f: f for _, f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = list(root)
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    low = {}
    for i, f in prints:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return sorted(((i, f"{f:016x}", low.get(find(f))) for i, f in prints), key=str)


def test_simhash(docs, corpus):
    got = sorted((tuple(r) for r in simhash.near_components(odd(docs)).collect()), key=str)
    assert got == brute_simhash(corpus)
    kept = simhash.drop_near_copies(odd(docs))
    assert kept.columns == odd(docs).columns
    groups = Counter(c for *_, c in brute_simhash(corpus))
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(groups)


def test_simhash_links(spark):
    """Dense fingerprints, dealt into small blocks, against all pairs."""
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(25)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    first = spark.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp long, first long")
    links = simhash.near_links(first.select("fp"), block=7)
    from tessera.llm.components import components

    got = {r["node"]: r["root"] for r in components(links).collect()}
    root = {f: f for f in signed}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(signed):
        for b in signed[:k]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {f: find(f) for f in signed if find(f) != f or any(find(g) == f for g in signed if g != f)}


def test_bpe(docs, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    want = []
    for i, t, *_ in corpus:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r) for r in bpe.bpe_digests(odd(docs), path).collect()), key=str) == sorted(want, key=str)
    encoded = bpe.encode_documents(docs, path)
    assert sorted((tuple(r) for r in bpe.decode_documents(encoded, path).select(F.sha2(F.col("text").cast("binary"), 256)).collect())) == sorted((w[3],) for w in want)


@pytest.mark.parametrize("text", ["a<|endoftext|>B <|startoftext|>", "Σίσυφος ΟΔΟΣ don't 12²³ ½ İstanbul ﬁ é 日本語 🤔🏽 \x1f\x85\xa0x​y", "aaaaabababababaaa" * 40, "!!!...?? '''s 'Ll", "ªº×÷ ß ẞ \x00\x7f"])
def test_bpe_texts(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, lib = bpe.loaded(path), Tokenizer.from_file(path)
    (ids,) = own.encode_batch([text])
    want = lib.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want and own.decode(ids) == lib.decode(want, skip_special_tokens=False)


def test_glob_automaton():
    import fnmatch

    rng = random.Random(2)
    globs = ["*.a/b**", "**/x", "**.z", "a*b*c**", "**", "*", "ab", "/**", *("".join(rng.choice("ab/") for _ in range(30)) for _ in range(4))]

    def regex(g):
        return re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", g)), re.S)

    texts = ["", "/", "ab", "aabbcc", ".a/b", "x.a/bc/d", "q/.a/b", "a/x", "a.z", globs[-1]] + ["".join(rng.choice("abcxz./") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    hits = urls.GlobAutomaton([g.encode() for g in globs]).run([t.encode() for t in texts])
    assert urls.GlobAutomaton([g.encode() for g in globs]).words > 1 and fnmatch
    assert hits.tolist() == [[bool(regex(g).fullmatch(t)) for g in globs] for t in texts]


def test_urls(spark):
    rows = [
        (1, "http://WWW.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        (3, "https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), (4, "x://b.net/fr/1", "b.net", "/fr/1", "net/fr/", "block"), (5, "x://b.net", "b.net", "", None, "allow"),
        (6, "no scheme", "", "", None, "block"), (7, None, "", "", None, "block"), (8, "http://h.org/a.net/es/", "h.org", "/a.net/es/", None, "allow"), (9, "http://h.org/login", "h.org", "/login", None, "block"),
        (9, "http://com/", "com", "/", "com/", "allow"), (None, "http://a.org#x://y", "a.org", "", None, "allow"), (10, "http://a.com?x/en", "a.com", "", None, "allow"), (11, "http://ads.x.org/p", "ads.x.org", "/p", None, "block"),
    ]
    got = urls.judge_urls(odd(spark.createDataFrame([(r[0], r[1], None) for r in rows], "page_id long, url string, html string")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r[0], *r[2:]) for r in rows), key=str)


def test_decontamination(spark, docs, corpus):
    rng = random.Random(9)
    items = [(k, prose(rng, 40)) for k in range(12)] + [(50, "too short"), (51, None), (52, "")]
    noisy = list(items[3][1])
    for p in range(10, len(noisy), 45):
        noisy[p] = "#"
    leaks = [(400, "before " + items[0][1] + " after"), (401, items[1][1].upper().replace(" ", "\n ")), (402, "x " + "".join(noisy)), (403, "y" * 50 + items[2][1][20:110] + "z" * 50), (404, items[4][1][:30] + prose(rng, 60))]
    table = docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in leaks], SCHEMA))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(odd(table), bench).collect()}
    assert got == {(400, 0), (401, 1), (402, 3), (403, 2)}
    left = decontaminate.drop_leaks(odd(table), bench)
    assert left.columns == odd(table).columns and left.count() == table.count() - 4
    parts = list(decontaminate.indexes(bench, most=500))
    assert len(parts) > 1 and sum(len(p.ids) for p in parts) == 13


def least_edits(segment, text):
    """Edits of the segment against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for k, c in enumerate(segment, 1):
        new = [k]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_decontamination_against_all_places(spark):
    """Items of all lengths against every stretch of every text."""
    rng = random.Random(17)
    items = [(k, prose(rng, n)) for k, n in enumerate((30, 16, 9, 6, 4, 12))] + [(20, "What is the capital of Peru?"), (21, "río été"), (22, "42"), (23, "?!"), (24, "is it")]
    texts = []
    for _, item in items[:6]:
        for edits in (0, 1, 2, 4, 6):
            own = list(item)
            for p in rng.sample(range(len(own)), min(edits, len(own) // 3)):
                own[p] = rng.choice(["", "#", own[p] + "+"])
            texts.append(prose(rng, 5) + " " + "".join(own) + " " + prose(rng, 5))
        texts.append(prose(rng, 5) + " " + item[len(item) // 3 :])
    texts += ["So: what IS the\n capital of Peru? Lima.", "somewhat is the capital of peru?", "RÍO  été", "arío été", "342 42nd 4 2", "(42)", "?!", "this it", "that is, is it?", "", None, "42"]
    brute = set()
    squeeze = lambda t: re.sub(r"\s+", " ", t or "").lower()
    for k, (_, item) in enumerate(items):
        own = decontaminate.SegmentIndex([(k, item)])
        for d, t in enumerate(texts):
            flat = squeeze(t)
            if len(squeeze(item)) < 32:
                spots = [m.start() for m in re.finditer(f"(?={re.escape(squeeze(item))})", flat)] if re.search(r"\w", item) else []
                n = len(squeeze(item))
                if any(not (p and flat[p - 1].isalnum() and flat[p].isalnum()) and not (p + n < len(flat) and flat[p + n].isalnum() and flat[p + n - 1].isalnum()) for p in spots):
                    brute.add((d, items[k][0]))
            elif any(least_edits("".join(map(chr, s)), flat) <= e for s, e in zip(own.segments, own.edits.tolist(), strict=True)):
                brute.add((d, items[k][0]))
    docs = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA)
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == brute and {20, 21, 22, 24} <= {i for _, i in got} and len(brute) >= 20
    spot = got[36, 20]
    assert texts[36][spot["start"] : spot["end"]] == "what IS the\n capital of Peru?"


def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_pii(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("12a@.+- ()9_%4é") for _ in range(60)) for _ in range(3000)]
    texts += ["é mail a.b@c.de.", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8 999.1.1.1", "+1 (555) 123-4567.", "IBAN: DE89 3704 0044 0532 0130 00", 'token = "0123456789abcdef0123"', "https://user:pass@host.org/x", None, "", "9" * 5000, "+1" + " " * 5000]
    found = pii.anchors()
    for t in texts:
        assert [s for s in pii.spans(t, found) if s[1] < 4] == (brute_spans(t) if t else [])
    extra = [pii.KINDS[k] for t in texts[3000:] for _, k, _ in pii.spans(t, found) if k > 3]
    assert extra == ["account", "secret", "login"]
    df = spark.createDataFrame([(k, t, None, None, 0) for k, t in enumerate(texts[3000:])], SCHEMA)
    rows = {r["doc_id"]: r for r in pii.find_personal_data(odd(df)).collect()}
    assert rows[0]["spans"] == "email:7:15" and rows[7]["spans"] == "" and rows[0]["base_sha256"] == hashlib.sha256(b"email:7:15").hexdigest()
    masked = {r["doc_id"]: r for r in pii.mask_personal_data(odd(df)).collect()}
    assert masked[0]["text"] == "é mail <EMAIL>." and masked[0]["n_chars"] == 15 and masked[7]["text"] is None


def test_language_id(spark):
    rng = random.Random(3)
    stems = {"aa": "ka lo mi tu re".split(), "bb": "zsch oei uhn prr wex".split(), "cc": "ção ñez éau íño".split()}
    rows = [(k, " ".join("".join(rng.choice(stems[g]) for _ in range(3)) for _ in range(25)), g, "s", 0) for k, g in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(900, None, "aa", "s", 0), (901, "123 !!", "aa", "s", 0), (None, "kalo mitu", "aa", "s", 0), (902, "kalo mitu relo", None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(df, langid.fold_of("doc_id") != 0)
    got = [tuple(r) for r in langid.identify(odd(df), model).collect()]
    held = {i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r["doc_id"] for r in df.where(langid.fold_of("doc_id") == 0).collect()} == held
    want = {i: g for i, _, g, *_ in rows if i is not None and i < 900}
    assert np.mean([want[i] == g for i, g, *_ in got if i in want and i in held]) > 0.95
    by_id = {i: (g, s) for i, g, s, _ in got}
    assert by_id[900] == by_id[901] == ("und", 0.0) and by_id[902][0] == "aa" and all(0 <= s <= 1 for _, s in by_id.values())


def brute_repeats(corpus):
    low, out = {}, []
    raws = [(i, (t or "").encode()) for i, t, *_ in corpus]
    rank = lambda i: 1 << 62 if i is None else i
    for i, raw in raws:
        for k in range(len(raw) - 49):
            w = raw[k : k + 50]
            low[w] = min(low.get(w, 1 << 63), rank(i))
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if low[raw[k : k + 50]] < rank(i):
                gone[k : k + 50] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_dedup(spark, docs, corpus, monkeypatch):
    assert sorted(map(tuple, suffixes.remove_repeats(odd(docs)).collect()), key=str) == brute_repeats(corpus)
    low_entropy = [(k, "x" * (40 + 7 * k) + "ab" * k, None, None, None) for k in range(30)]
    df = spark.createDataFrame(low_entropy, SCHEMA).repartition(4)
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 500)
    assert sorted(map(tuple, suffixes.remove_repeats(df).collect()), key=str) == brute_repeats(low_entropy)


def test_loser_tree():
    rng = random.Random(8)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(rng.randint(0, 30))) for _ in range(7)]
    coded = [suffixes.front_code(r) for r in runs]
    assert [suffixes.front_decode(*c) for c in coded] == runs
    got = list(suffixes.merge_runs(runs, [c[0].tolist() for c in coded]))
    flat = [runs[r][k] for r, k, _ in got]
    assert flat == sorted(x for r in runs for x in r)
    assert [s for *_, s in got[1:]] == [suffixes.common_prefix(a, b, 0) for a, b in zip(flat, flat[1:])]


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_reader(zip64):
    raw = warc.pack([(1, "http://a/\r\n%", b"payload", None), (2, None, b"payload", 1), (None, "u", b"", None)], zip64)
    reads = []

    def read(at, n):
        reads.append(n)
        return raw[at : at + n]

    got = list(warc.read_records(read, len(raw)))
    assert [(p, f["WARC-Type"], x) for p, f, x in got] == [(1, "response", b"payload"), (2, "revisit", b""), (None, "response", b"")]
    import io
    import zipfile

    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and set(z.namelist()) == {warc.MEMBER, warc.INDEX}
    with pytest.raises(ValueError):
        warc.ZipReader(lambda a, n: b"x" * n, 100)


def test_warc(spark):
    rows = [(3, "http://a/\n", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://b", None), (5, "http://c", ""), (7, "http://d", "x" * 100_000), (None, "http://e", "<p>é</p>"), (3, "http://a", "<p>é</p>")]
    got = warc.records(warc.archives(odd(spark.createDataFrame(rows, "page_id long, url string, html string")))).collect()
    first = {"<p>é</p>": 1, "": 2, "x" * 100_000: 7}
    want = []
    for i, u, h in rows:
        target = first[h or ""] if i is not None and i > first[h or ""] else None
        want.append((i, u or "about:blank", len((h or "").encode()), warc.digest((h or "").encode()), "revisit" if target else "response", target))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)


def test_warc_hot_payload(spark, monkeypatch):
    """Half of all pages equal, over many partitions, and a page larger than an archive."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(7)
    big = "".join(chr(rng.randint(33, 0x2FFF)) for _ in range(100_000))
    rows = [(k, f"http://h{k}/", "<p>same</p>" if k % 2 else f"<p>{rng.random()}</p>") for k in range(1200)] + [(5000, "http://big/", big), (5001, "http://big/", big)]
    packed = warc.archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(200))
    assert packed.count() > 4
    got = {r["page_id"]: r for r in warc.records(packed).collect()}
    assert len(got) == len(rows)
    for k, u, h in rows:
        target = 1 if k % 2 and 1 < k < 1200 else 5000 if k == 5001 else None
        r = got[k]
        assert (r["url"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (u, len(h.encode()), warc.digest(h.encode()), target)
        assert r["payload"] == (None if target is not None else h.encode())


def brute_counts(t):
    words = re.findall("[^\x20\x09-\x0d]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    tri = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    n = Counter(tri)
    covered = {k + j for k, x in enumerate(tri) if n[x] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, docs, corpus):
    more = [(500, "a b c a b c a\nx\nx\n\n \n\nx #$", "en", "s", 0), (501, "the the the the", "en", "s", 0), (502, "\x1f a\x0bb \x85 \xa0", "en", "s", 0), (503, ("SHOUT!!## " * 80).strip(), "en", "s", 0), (504, " ".join(f"W{k}%%%" for k in range(90)), "en", "s", 0)]
    table = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    rows = quality.judge_quality(odd(table)).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows), key=str)
    assert got == sorted(((i, *brute_counts(t)) for i, t, *_ in corpus + more), key=str)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert not {r["doc_id"]: r["kept"] for r in rows}[504]
    kept = quality.keep_quality(odd(table))
    assert kept.columns == odd(table).columns and kept.count() == sum(r["kept"] for r in rows)


def test_jensen_shannon(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 12).tolist(), rng.integers(0, 50, 12).tolist()
    df = spark.createDataFrame([(a, b, sum(a), sum(b))], "a array<long>, b array<long>, x long, y long")
    p, q = np.array(a) / sum(a), np.array(b) / sum(b)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        want = np.sqrt((np.nansum(p * np.log2(p / m)) + np.nansum(q * np.log2(q / m))) / 2)
    assert df.select(quality.jensen_shannon("a", "b", "x", "y")).first()[0] == pytest.approx(want)


def test_passages(docs, corpus):
    got = passages.near_duplicate_passages(odd(docs)).collect()
    words, owners = defaultdict(list), defaultdict(set)  # an id may have several rows
    for i, t, *_ in corpus:
        w = (t or "").lower().split()
        words[i].append(w)
        for k in range(len(w) - 49) if i is not None else ():
            owners[tuple(w[k : k + 50])].add(i)
    need = {i for own in owners.values() if len(own) > 1 for i in own}
    assert need <= {r["doc_id"] for r in got} | {r["other_doc_id"] for r in got}

    def similarity(r, u, v):
        a, b = u[r["start_word"] : r["end_word"]], v[r["other_start_word"] : r["other_end_word"]]
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
        return len(x & y) / max(1, len(x | y))

    for r in got:
        assert r["doc_id"] != r["other_doc_id"] and r["similarity"] >= 0.8
        assert max(r["end_word"] - r["start_word"], r["other_end_word"] - r["other_start_word"]) >= 50
        assert any(similarity(r, u, v) == pytest.approx(r["similarity"]) for u in words[r["doc_id"]] for v in words[r["other_doc_id"]])


def test_passage_with_repeated_phrase():
    """Phrases of a passage that also stand elsewhere in the other text, one or many, by an edit or not, don't hide it."""
    new = iter(range(1000, 100_000))
    fresh = lambda n: [next(new) for _ in range(n)]
    passage = fresh(46)
    x = np.array(fresh(20) + passage + fresh(20), np.int32)

    def found(x, y):
        return passages.similar_stretches(np.array(x, np.int32), np.array(y, np.int32))

    assert found(passage, [passage[20], *fresh(29), *passage]) == [(0, 45, 30, 75, 1.0)]
    for before in ([20], range(30), range(20, 46), [0, 20, 45], range(46)):
        y = [t for k in before for t in ([passage[k]] if len(before) > 3 else [passage[k], *fresh(30)])] + fresh(40)
        assert (20, 65, len(y), len(y) + 45, 1.0) in found(x, [*y, *passage, *fresh(9)]) or len(before) == 46
        assert found(x, [*fresh(9), *passage, *y])[0][:2] == (20, 65)
    edited = passage + fresh(20)
    y = [edited[24], *fresh(40), *edited[:25], *fresh(5), *edited[30:]]
    assert [f[:4] for f in found(edited, y)] == [(0, 65, 41, 106)]
    assert found([7] * 3000, [7] * 2500) and found([7, 8] * 3000, [8] * 60 + [7, 8] * 2000)


def test_passages_in_another_order():
    """Windows of two passages that interleave in one text and are apart in the other are two candidates, also over batches."""
    import pyarrow as pa

    windows = [(0, 60, 500, 560), (5, 65, 10, 70), (10, 70, 500, 560), (15, 75, 10, 70)]
    rows = [(9, 4, *w, k) for k, w in enumerate(windows)] + [(9, 5, 1, 50, 1, 50, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], ["a", "b", "a_lo", "a_hi", "b_lo", "b_hi", "key"]) for part in (rows[:2], rows[2:])]
    got = [tuple(r.values()) for b in passages._stretches(batches) for r in b.to_pylist()]
    assert [g[:2] for g in got] == [(9, 4), (9, 5)] and sorted(zip(*got[0][2:6], strict=True)) == [(0, 70, 500, 560), (5, 75, 10, 70)]
    assert sorted(got[0][6]) == [0, 1, 2, 3] and got[1][6:] == ([7],)


def brute_pairs(rows):
    """Pairs of ids whose texts share 50 words in a row, and of those with a stretch of 50 words of five-word similarity 0.8."""
    words = {i: t.lower().split() for i, t in rows}
    grams = {i: [tuple(w[k : k + 5]) for k in range(len(w) - 4)] for i, w in words.items()}
    equal, near = set(), set()
    for i, x in grams.items():
        for j, y in grams.items():
            if i < j:
                spans = [(set(x[a : a + 46]), a) for a in range(0, len(x) - 45)]
                others = [set(y[b : b + 46]) for b in range(0, len(y) - 45)]
                if {tuple(x[a : a + 46]) for a in range(len(x) - 45)} & {tuple(y[b : b + 46]) for b in range(len(y) - 45)}:
                    equal.add((i, j))
                if any(len(u & v) >= 0.8 * len(u | v) for u, _ in spans for v in others):
                    near.add((i, j))
    return equal, near


def classes_of(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("few, block", [(50, 512), (2, 512), (2, 4)])
def test_passages_against_all_pairs(spark, monkeypatch, few, block):
    """Equal passages are all found and similar ones as often as chance says, in whichever way the nodes of a key meet; classes are those of all pairs."""
    monkeypatch.setattr(passages, "BLOCKS", 1 if block < 10 else 16)
    rng = random.Random(3)
    new = iter(range(10**6))
    fresh = lambda n: [f"w{next(new)}" for _ in range(n)]
    line = fresh(14)
    rows = []
    for g in range(14):
        passage = fresh(60)
        for k in range(3):
            own = list(passage)
            for p in rng.sample(range(60), k):
                own[p] = fresh(1)[0]
            rows.append((10 * g + k, " ".join(fresh(rng.randint(0, 30)) + line + own + fresh(rng.randint(0, 30)))))
    equal, near = brute_pairs(rows)
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).repartition(3)
    out = passages.near_duplicate_passages(docs, few, block).collect()
    got = {tuple(sorted((r["doc_id"], r["other_doc_id"]))) for r in out}
    own, want = classes_of(got), classes_of(near)
    assert len(near) >= 20 and all(own.get(i) == own.get(j) is not None for i, j in equal)
    assert np.mean([own.get(i) == own.get(j) is not None for i, j in near]) >= 0.9
    assert all(want.get(i) == want.get(j) for i, j in got) and {r["doc_id"]: r["class_id"] for r in out}.items() <= own.items()


def test_passages_behind_quotes(spark):
    """Documents that quote a passage's shingles one by one, with smaller and larger ids, don't hide two that share it, nor do rows of one id."""
    new = iter(range(10**6))
    fresh = lambda n: [f"w{next(new)}" for _ in range(n)]
    passage = fresh(60)

    def quotes():
        return " ".join(x for k in range(56) for x in passage[k : k + 5] + fresh(3))

    rows = [(k, quotes()) for k in range(15)] + [(k, quotes()) for k in range(50, 65)]
    rows += [(i, " ".join(fresh(20) + passage + fresh(20))) for i in (30, 31)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).repartition(3)
    got = [r for r in passages.near_duplicate_passages(docs).collect() if r["similarity"] == 1]
    assert [(r["doc_id"], r["other_doc_id"], r["end_word"] - r["start_word"]) for r in got] in ([(31, 30, 60)], [(30, 31, 60)])
    other = " ".join(fresh(80))
    rows = [(1, " ".join(fresh(9) + passage)), (2, other), (2, " ".join(passage + fresh(9))), (3, other), (3, " ".join(fresh(7) + passage)), (None, other)]
    got = passages.near_duplicate_passages(spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).coalesce(1)).collect()
    assert {frozenset((r["doc_id"], r["other_doc_id"])) for r in got} >= {frozenset((1, 2)), frozenset((2, 3))} and {r["class_id"] for r in got} == {1}
    assert any(r["end_word"] - r["start_word"] == 80 and {r["doc_id"], r["other_doc_id"]} == {2, 3} for r in got)


@pytest.mark.parametrize("function", [0, 1])
def test_compact_windows(function):
    rng = np.random.default_rng(1)
    token, count = rng.integers(0, 400, 700).astype(np.uint64), np.array([100, 0, 300, 45, 46, 209])
    want, s = [], 0
    for t, n in enumerate(count):
        v = [(a, i) for i, a in enumerate(passages.order_of(token[s : s + n], function).tolist())]
        s += n
        for c in range(n):
            lo = max((k + 1 for k in range(c) if v[k] < v[c]), default=0)
            hi = min((k - 1 for k in range(c + 1, n) if v[k] < v[c]), default=n - 1)
            if hi - lo + 1 >= passages.TOKENS:
                want.append((t, lo, c, hi))
    assert sorted(zip(*(x.tolist() for x in passages.compact_windows(token, count, function)), strict=True)) == sorted(want)


def test_pipeline_near_copies(spark):
    """The stage finds all pairs of similarity 0.8 on five-word shingles, also those that fingerprints miss, and keeps other texts."""
    import corpus_pipeline
    from tessera.llm import jaccard

    rng = random.Random(21)
    rows = []
    for g in range(12):
        base = prose(rng, rng.randint(70, 200)).split()
        for k in range(5):
            words = list(base)
            for p in rng.sample(range(len(words)), k * len(words) // 70):
                words[p] = f"new{g}x{k}"
            rows.append((10 * g + k, " ".join(words), "en", "s", 0))
    rows += [(900, "one two", "en", "s", 0), (901, None, "en", "s", 0)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t, *_ in rows if len(w := (t or "").lower().split()) > 4}
    root = {c: c for c in sets}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    prints = {i: simhash.fingerprint(t) for i, t, *_ in rows}
    missed = 0
    for a in sets:
        for b in sets:
            similar = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            near = ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 4
            missed += similar and not near
            if a < b and (similar or near):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert missed
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert left == {i for i in root if find(i) == i} | {900, 901}
    texts = spark.createDataFrame([(i, t) for i, t, *_ in rows], "fp long, text string")
    joined = {frozenset(r) for r in jaccard.similar_links(texts, block=2).collect()}
    assert joined and all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in joined)


def test_similar_links_meet_once(spark):
    """Texts that share several keys meet in the first of them alone, those that share a key by chance not at all, and no table stays behind."""
    from tessera.llm import jaccard
    from tessera.session import shared_folder

    def met(texts):
        _, _, keys, minima = jaccard._sets([t.encode() for t in texts])
        keys[:, 7] = 7  # a key that all share
        rows = sorted((int(k), 0, 0, 0, n, n, keys[n].tobytes() + minima[n].tobytes()) for n in range(len(texts)) for k in keys.view(np.int64)[n])
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["key", "lo", "hi", "part", "node", "root", "mark"])
        return [r for b in jaccard._meet(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]

    words = [f"w{k}" for k in range(200)]
    alike = [" ".join([*words[:195], f"end{k}"]) for k in range(6)]
    others = [" ".join([*words[:40], *(f"own{k}x{n}" for n in range(160))]) for k in range(20)]
    assert sorted(met([*alike, *others])) == [(a, b) for a in range(6) for b in range(a + 1, 6)]
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    texts = spark.createDataFrame(list(enumerate([*alike, *others])), "fp long, text string")
    links = {frozenset(r) for r in jaccard.similar_links(texts).collect()}
    assert {n for k in links for n in k} == set(range(6))
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before}
    assert not left & {"sets", "shared", "met", "named", "pairs", "bands"}


def test_pipeline(spark, corpus, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    item = prose(rng, 40)
    rows = corpus + [(600, prose(rng, 60) + " " + item, "en", "s", 0), (601, prose(rng, 90) + " mail a@b.co", "en", "s", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.STAGES[0][0]] == [5, "quality_rules"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == before.columns
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 600 not in left and left[601].endswith("mail <EMAIL>") and 300 not in left
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str)
    assert len(got) == len(left)
    own = bpe.loaded(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: hashlib.sha256(x).hexdigest() for i, x in zip(left, own.encode_batch(left.values()), strict=True)}
    assert {r[0]: r[2] for r in got} == want
