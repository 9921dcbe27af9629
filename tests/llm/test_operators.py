"""The text operators against brute force, the libraries, and the cases that their docstrings define."""

import hashlib
import random
import re
import subprocess
import sys
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attestor.llm import byte_bpe, common, exact_dedup, fingerprints, html_wrappers, language_id, lm_scoring, ngram_join, packing, substring_dedup, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(90)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, empties, white space, odd characters, a long text, repeated rows."""
    base = [prose(i, 60 + 7 * i) for i in range(12)]
    near = [" ".join(w if k != 5 + j else "changed" for k, w in enumerate(base[3].split())) for j in range(4)]
    passage = ". ".join(prose(100 + i, 12) for i in range(6)) + ". "
    texts = [*base, *near, base[0], base[0].replace(" ", "  \n"), base[1].upper(), None, "", " \t\n", "one two", "ONE\ttwo", "中文 test's ’ é ß", "é́", "😀" * 40, "12 345's", prose(50, 4000)]
    texts += [base[7] + "\n" + passage + base[8], "Intro line. " + passage + "\n" + base[9], "a\x00b\x1c c\x85d", "x" * 5000, "<|endoftext|> a <|startoftext|>b"]
    out = [(i, t, ["en", "de"][i % 2], "s", len(t or "")) for i, t in enumerate(texts)]
    return [*out, (None, "no id at all", "en", "s", 0), (None, base[2], None, None, None), out[4], out[4], (5, "same id, other text", "en", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = ["kind", "node", "h", "row", "rank", "lang_pred", "_h", "_t", "removed"]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in clash:
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    fold = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_word_shingles_and_hashes(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, at = common.shingles(buf, offs)
    seen = {}
    for i, (_, t, *_) in enumerate(rows):
        own = h[at[i] : at[i + 1]]
        assert len(set(own.tolist())) == len(shingle_set(t))
        w = words_of(t)
        for k, x in enumerate(own.tolist()):
            assert seen.setdefault(x, tuple(w[k : k + 5])) == tuple(w[k : k + 5])


def test_ngram_components(docs, rows, empty):
    sets = [shingle_set(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 80 * len(sets[i] | sets[k]):
                group[root(i)] = root(k)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    expected = sorted(((d, len(s), least.get(root(i))) for i, ((d, *_), s) in enumerate(zip(rows, sets, strict=True))), key=str)
    got = sorted((tuple(r) for r in ngram_join.ngram_components(docs).collect()), key=str)
    assert got == expected
    assert ngram_join.ngram_components(empty).count() == 0


def test_signature_trees_lose_no_pair():
    rng = np.random.default_rng(5)
    family = rng.integers(0, 1 << 62, (12, 60), dtype=np.uint64)
    sets = []
    for i in range(150):
        own = family[i % 12].copy()
        own[rng.integers(0, 60, rng.integers(0, 9))] = rng.integers(0, 1 << 62, 1, dtype=np.uint64)
        sets.append(np.unique(own))
    maps = np.stack([ngram_join._bitmap(s) for s in sets])
    n = np.array([len(s) for s in sets], np.int64)
    tree = ngram_join.SignatureTree(maps, n, n - np.bitwise_count(maps).sum(1), np.arange(len(sets)))
    found = set(map(tuple, tree.pairs_with(tree).tolist()))
    for i in range(len(sets)):
        for k in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[k]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[k]) - both):
                assert (i, k) in found
    assert len(found) < 150 * 149 / 2 / 4
    half = ngram_join.SignatureTree(maps[:70], n[:70], (n - np.bitwise_count(maps).sum(1))[:70], np.arange(70))
    rest = ngram_join.SignatureTree(maps[70:], n[70:], (n - np.bitwise_count(maps).sum(1))[70:], np.arange(70, 150))
    assert set(map(tuple, (half.pairs_with(rest) + [0, 70]).tolist())) == {p for p in found if p[0] < 70 <= p[1]}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    for one_task in (0, 1000):
        got = {r["node"]: r["root"] for r in ngram_join.components(edges, one_task).collect()}
        assert {got[i] for i in range(1, 41)} == {0} and got[101] == 100 and len(got) == 41


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1 << 63), (5, 20), (3000, 1 << 63), (1000, 1200)):
        v = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        assert (exact_dedup.ungolomb(exact_dedup.golomb(v)) == v).all()


def test_exact_duplicates(docs, rows, empty):
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in rows]
    groups = {}
    for (d, t, *_), b in zip(rows, bare, strict=True):
        groups.setdefault(b, []).append((-len(t or ""), d is None, d))
    expected = sorted(((d, min(groups[b])[2], len(groups[b]), hashlib.sha256(b.encode()).hexdigest()) for (d, *_), b in zip(rows, bare, strict=True)), key=str)
    out = exact_dedup.exact_duplicates_report(docs).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out), key=str) == expected
    assert sum(r["kept"] for r in out) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    assert exact_dedup.exact_duplicates_report(empty).count() == 0
    stays = exact_dedup.distinct_documents(docs)
    assert stays.columns == docs.columns and stays.count() == len(groups)


def test_byte_bpe(docs, rows, empty):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(byte_bpe.default_path())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for d, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        expected.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in byte_bpe.encode_decode_digests(docs).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert byte_bpe.encode_decode_digests(empty).count() == 0


def test_pretokens_on_random_strings():
    import public_tokenizers
    import regex

    pattern, rnd = regex.compile(public_tokenizers.PATTERN), random.Random(3)
    alphabet = ["'s", "'t", "'re", "'", "''", "'ll", "'v", "s", "x", " ", "  ", "\n", "\t", " ", "　", "1", "²", "é", "中", "😀", "!", " '", "'S", "\x85", "\x1c", "́", "ll", "re"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(12))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, at = byte_bpe.pretokens(buf, offs)
    whole = buf.tobytes()
    for i, t in enumerate(texts):
        assert [whole[starts[k] : ends[k]].decode() for k in range(at[i], at[i + 1])] == pattern.findall(t)


def test_token_counts(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_counts.default_path())
    expected = []
    for d, t, *_ in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected.append((d, len((t or "").encode()), n, n > 2048))
    got = [tuple(r) for r in token_counts.token_counts(docs).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(empty).count() == 0
    assert token_counts.lowered("ΑΣ") == "ας".replace("ς", "σ") and token_counts.lowered("é") == unicodedata.normalize("NFC", "é")


def test_packing(docs, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for d, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at, size = 0, len(ids) % 1024 or min(1024, len(ids))
        while at < len(ids):
            key = (d, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes()))
            expected[key] = expected.get(key, 0) + 1
            at, size = at + size, 1024
    out = packing.packed_pieces(docs).collect()
    got = {}
    for r in out:
        key = (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
    assert got == expected
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    assert len(by) == -(-sum(r["length"] for r in out) // 1024)
    assert packing.packed_pieces(empty).count() == 0


def test_packing_in_rounds(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1024, 12000)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "item long, size long")
    out = packing.pack(items, group=4000).collect()
    size = dict(enumerate(sizes.tolist()))
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], size[r["item"]]))
    assert sorted(r["item"] for r in out) == list(range(12000))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    assert len(by) <= 1.02 * sizes.sum() / 1024 + 1


def test_language_id(spark, docs, rows, empty):
    letters = {"en": "the of and with tion".split(), "de": "der und ich ein schön".split(), "fr": "le être que à ou".split()}
    rnd = random.Random(4)
    made = [(i, " ".join(rnd.choice(letters[k]) + rnd.choice(["", "en", "er"]) for _ in range(30)), k) for i, k in enumerate(["en", "de", "fr"] * 100)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in language_id.language_predictions(df).collect()}
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == out[i]["held_out"] for i, *_ in made)
    assert np.mean([out[i]["lang_pred"] == k for i, _, k in made if out[i]["held_out"]]) > 0.97
    got = language_id.language_predictions(docs).collect()
    assert len(got) == len(rows)
    none = {d for d, t, *_ in rows if d is not None and not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == none
    assert all(0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    assert language_id.language_predictions(empty).count() == 0


def brute_repeats(rows, least):
    """Texts after removal, by sets of normalised units in Python."""
    ranked = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    units = {i: [u for u in re.split(r"(?<=\n)|(?<=[.!?] )", rows[i][1] or "") if u] for i in ranked}
    norm = {i: [" ".join(words_of(u)) for u in units[i]] for i in ranked}
    first = {}
    for i in ranked:
        rank = (rows[i][0] is None, rows[i][0] or 0)
        for u in norm[i]:
            first.setdefault(u, rank)
    out = []
    for i, (d, t, *_) in enumerate(rows):
        rank, seen, marked = (d is None, d or 0), set(), []
        for u in norm[i]:
            marked.append(bool(u) and (first[u] != rank or u in seen))
            seen.add(u)
        keep, k = [True] * len(marked), 0
        while k < len(marked):
            if not marked[k]:
                k += 1
                continue
            to = k
            while to < len(marked) and (marked[to] or not norm[i][to]):
                to += 1
            if sum(len(u.split()) for u in norm[i][k:to]) >= least:
                last = max(x for x in range(k, to) if marked[x])
                keep[k : last + 1] = [False] * (last + 1 - k)
            k = to
        out.append((d, None if t is None else "".join(u for u, x in zip(units[i], keep, strict=True) if x)))
    return out


def test_substring_dedup(docs, rows, empty):
    out = substring_dedup.substring_dedup_report(docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(brute_repeats(rows, substring_dedup.MIN_WORDS), key=str)
    original = {(d, t) for d, t, *_ in rows}
    for r in out:
        if r["n_removed"]:
            ok = False
            for d, t in original:
                if d == r["doc_id"] and t:
                    cut, at = [], 0
                    for span in r["removed"].split(";"):
                        x, n = map(int, span.split("<")[0].split("+"))
                        cut.append(t[at:x])
                        at = x + n
                    ok |= "".join(cut) + t[at:] == r["text"]
            assert ok
    assert substring_dedup.substring_dedup_report(empty).count() == 0


def test_lm_scores(docs, rows, empty):
    out = {(r["doc_id"], r["n_words"]): r for r in lm_scoring.lm_scores(docs).collect()}
    assert {(d, len(words_of(t))) for d, t, *_ in rows} == set(out)
    assert all(r["mean_log_likelihood"] is None if r["n_words"] == 0 else r["mean_log_likelihood"] < 0 for r in out.values())
    assert lm_scoring.lm_scores(empty).count() == 0


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def lm_tables(texts):
    """Own words, their counts and all tokens' counts of texts, in Python."""
    h, _ = lm_scoring.word_hashes(*flat(texts))
    words, n = np.unique(h, return_counts=True)
    own = words[np.lexsort((words, -n))[: lm_scoring.OWN]]
    counts = np.zeros(lm_scoring.TOKENS)
    np.add.at(counts, lm_scoring.Tokens(own).of(words), n)
    return own, counts


def test_lm_probabilities_by_brute_force_and_learning():
    rng = np.random.default_rng(3)
    text = " ".join(["a b c d", "e f g h"][k] for k in rng.integers(0, 2, 3000))
    buf, offs = flat([text, "", "a x"])
    own, counts = lm_tables([text, "a x"])
    h, at = lm_scoring.word_hashes(buf, offs)
    token = lm_scoring.Tokens(own).of(h)
    weights = lm_scoring.start(counts)
    unigram = lm_scoring.token_sums(weights, token, at)
    every = np.maximum(counts, lm_scoring.UNSEEN)
    assert abs(unigram[0] - np.log(every[token[: at[1]]] / every.sum()).sum()) < 1e-4 * abs(unigram[0])
    around = lm_scoring.contexts(token, at)
    for _ in range(30):
        lm_scoring.learn(weights, around, token, 1.0)
    total = lm_scoring.token_sums(weights, token, at)
    assert total[0] / at[1] > -0.5 > unigram[0] / at[1] and total[1] == 0
    m, words = lm_scoring.split(weights), [lm_scoring.EDGE] * 2 + token[: at[1]].tolist() + [lm_scoring.EDGE] * 2
    brute = 0.0
    for i in range(at[1]):
        x = np.concatenate([m["e"][words[i + 2 + d]] for d in (-2, -1, 1, 2)]).astype(np.float64)
        hid = np.append(np.tanh(x @ m["w"] + m["b"]), 1)
        c, k = divmod(words[i + 2], lm_scoring.MEMBERS)
        for z, y in ((hid @ m["u"], c), (hid @ m["v"][c], k)):
            brute += z[y] - np.log(np.exp(z - z.max()).sum()) - z.max()
    assert abs(brute - total[0]) < 1e-3 * abs(brute)


def test_lm_gradient_by_differences():
    """A small step lowers the loss by its length times the gradient's square, as the exact gradient does."""
    texts = [prose(i, 300) for i in range(4)]
    own, counts = lm_tables(texts)
    h, at = lm_scoring.word_hashes(*flat(texts))
    token = lm_scoring.Tokens(own).of(h)
    around, before = lm_scoring.contexts(token, at), lm_scoring.start(counts)
    for _ in range(3):
        lm_scoring.learn(before, around, token, 0.5)
    loss = lambda w: -lm_scoring.token_sums(w, token, at).sum() / len(token)
    after = before.copy()
    lm_scoring.learn(after, around, token, 1e-2)
    moved = lm_scoring.split(after - before)
    base = lm_scoring.split(before)
    for name in ("e", "w", "b", "u", "v"):
        one = before.copy()
        lm_scoring.split(one)[name][:] = base[name] + moved[name]
        assert loss(one) < loss(before) + 1e-6
    assert loss(after) < loss(before)


def test_lm_beats_counts_on_held_out_text():
    rng = random.Random(5)
    langs = [[f"{p}{w}" for w in range(400)] for p in "abcd"]
    make = lambda n: [" ".join(rng.choices(langs[i % 4], [1 / (k + 1) for k in range(400)], k=200)) for i in range(n)]
    train, held = make(300), make(40)
    own, counts = lm_tables(train)
    weights = lm_scoring.start(counts)
    tokens = lm_scoring.Tokens(own)
    h, at = lm_scoring.word_hashes(*flat(train))
    token = tokens.of(h)
    for _ in range(3):
        lm_scoring.learn(weights, lm_scoring.contexts(token, at), token, lm_scoring.RATE)
    h, at = lm_scoring.word_hashes(*flat(held))
    token = tokens.of(h)
    gain = (lm_scoring.token_sums(weights, token, at).sum() - lm_scoring.token_sums(lm_scoring.start(counts), token, at).sum()) / len(token)
    assert gain > 0.5  # nats a word: the language shows in its neighbours


def test_fingerprints(docs, rows, empty):
    out = fingerprints.fingerprint_report(docs).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    order = sorted((d for d, *_ in rows if d is not None and d not in (4, 5)), reverse=True)
    text = {d: t or "" for d, t, *_ in rows if d is not None and d not in (4, 5)}
    for d, after in zip(order, order[1:], strict=False):
        if d - after != 1:
            continue
        t, r = text[d], by[d][0]
        k = len(t) // 3
        edited = t[: len(t) - k] + text[after][:k]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
        if len(words_of(t)) > 100 and len(t) < 20_000:
            a, b = ({s for s in shingle_set(x.lower())} for x in (t, edited))
            assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 0.17
    assert by[0][0]["fingerprint"] == by[16][0]["fingerprint"]
    assert by[20][0]["fingerprint"] == "" and by[20][0]["near_next"] == 1.0
    assert len({r["fingerprint"] for r in by[4]}) == 1 and sum(r["near_next"] == 1.0 for r in by[4]) >= 2
    assert fingerprints.fingerprint_report(empty).count() == 0


def test_likeness_is_unbiased(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(10**9)}" for _ in range(24 if i % 2 else 400)]
        other = words[: len(words) // 2] + [f"v{rng.randrange(10**9)}" for _ in range(len(words) - len(words) // 2)]
        rows.append((i, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "pa"), "b", "pb").select("i", fingerprints.likeness("pa", "pb").alias("j"))
    error = []
    for r in df.collect():
        a, b = shingle_set(rows[r["i"]][1]), shingle_set(rows[r["i"]][2])
        error.append(r["j"] - len(a & b) / len(a | b))
    assert abs(np.mean(error)) < 0.03


def test_html(spark):
    page = lambda n, body, more="": f'<!DOCTYPE html><html><head><title>T{n}</title><script>var t="</p>";</script></head><body><nav><ul>{"<li><a href=/x>menu</a></li>" * n}</ul></nav><div class="ad">Buy {n}</div><article><h1>Head {n}</h1>{body}</article>{more}<footer>&copy; f</footer></body></html>'
    rows = [
        (1, "http://a.org/1", page(3, "<p>One &amp; <b>two</b>\n  three.</p><p>x<br>y</p>")),
        (2, "http://a.org/2", page(1, "<p>Only.")),
        (3, "http://a.org/3", page(5, "<ul><li>i<li>j</ul>", "<aside>side</aside><section class='comments'><p>first!</p></section>")),
        (4, "http://b.org/", "<div id=wrap><div class='menu'>m</div><div class=content><p>Long paragraph of text here.</p><p>And another one.</p></div><form>mail</form></div>"),
        (5, None, None), (6, "http://c.org", ""), (7, "http://c.org", "plain < text &lt;b&gt;"), (None, "http://c.org", "<p>cut off <b>he"),
        (2, "http://a.org/2", page(1, "<p>Only.")), (9, "http://a.org/9", page(2, "<div class=cookie-notice>ok?</div><p>&#233; &nbsp;z</p><header>sub</header>")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("salt", F.lit(1)).withColumn("text", F.lit("t"))
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_wrappers.main_texts(df).collect()), key=str)
    expected = [
        (1, "Head 3\nOne & two three.\nx y"), (2, "Head 1\nOnly."), (2, "Head 1\nOnly."), (3, "Head 5\ni\nj"), (4, "Long paragraph of text here.\nAnd another one."),
        (5, ""), (6, ""), (7, "plain < text <b>"), (None, "cut off he"), (9, "Head 2\né z\nsub"),
    ]
    assert got == sorted(((i, t, len(t)) for i, t in expected), key=str)
    assert html_wrappers.main_texts(df.limit(0)).count() == 0


def test_wrapper_matches_all_it_has_met():
    w = html_wrappers.Wrapper()
    pages = [list("abcbcbcd"), list("abcd"), list("abcxd"), list("ad"), list("abcbcyd"), list("aqbcd")]
    for p in pages:
        w.refine(p)
        assert w.matches(p)
    assert w.matches(list("abcbcbcbcd")) and not w.matches(list("dcba"))


def test_wrapper_tells_template_from_data():
    page = lambda n, more="": f"<article><h1>Head {n}</h1><div class=zz>Brought to you by us</div><p>Body {n}.</p><p>More {n}.</p>{more}<h6>Read on</h6></article>"
    pages = [page(1), page(2, "<ul><li>x</ul>"), page(3), page(3), page(4, "<p>Brought to you by us</p>")]
    assert html_wrappers.extract(pages) == ["Head 1\nBody 1.\nMore 1.", "Head 2\nBody 2.\nMore 2.\nx", *["Head 3\nBody 3.\nMore 3."] * 2, "Head 4\nBody 4.\nMore 4.\nBrought to you by us"]
    assert html_wrappers.extract([page(1)] * 5) == ["Head 1\nBrought to you by us\nBody 1.\nMore 1.\nRead on"] * 5


def test_wrapper_text_of_a_large_host(spark):
    n = html_wrappers.PORTION * 3
    df = spark.createDataFrame([(i, "http://a.org/", f"<article><p>t</p><p>Body {i}</p><div class=zz>all alike</div></article>") for i in range(n)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrappers.main_texts(df.repartition(7)).collect()}
    assert {i: t.split("\n")[-1] for i, t in got.items()} == {i: f"Body {i}" for i in range(n)}


def test_lm_training_masks_every_position_once(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace

    texts, met = [prose(i, 5 + i) for i in range(40)], []
    own, counts = lm_tables(texts)
    monkeypatch.setattr(lm_scoring, "learn", lambda weights, around, target, rate: met.extend(target.tolist()))
    shared = SimpleNamespace(value=(lm_scoring.start(counts), own))
    for number in range(lm_scoring.ROUNDS):
        list(lm_scoring._train(shared, number)([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    h, _ = lm_scoring.word_hashes(*flat(texts))
    assert sorted(met) == sorted(lm_scoring.Tokens(own).of(h).tolist())


def test_lm_average_is_weighted_by_words():
    import pyarrow as pa

    part = lambda x: np.full(3, x, "<f4").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([4, 4, 5], pa.int32()), pa.array([1, 3, 2], pa.int64()), pa.array([part(1 * 1), part(3 * 5), part(2 * 7)], pa.binary())], ["block", "n", "part"])
    (four, five) = lm_scoring._average([batch])
    assert np.frombuffer(four.column(1)[0].as_py(), "<f4").tolist() == [4, 4, 4] and np.frombuffer(five.column(1)[0].as_py(), "<f4").tolist() == [7, 7, 7]


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_lm_counts_of_words_that_share_a_token(spark, monkeypatch, head):
    shared = lambda w: int(lm_scoring.word_hashes(*flat([w]))[0][0]) & (lm_scoring.SHARED - 1)
    by, pair = {}, None
    for i in range(10_000):
        w = f"w{i}"
        pair = pair or (by[shared(w)], w) if shared(w) in by else pair
        by[shared(w)] = w
    often, once = pair
    texts = [f"{often} filler{i}" for i in range(40)] + [once, often, often]
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.lm_scores(df).collect()}
    assert len(got) == 43 and got[41] == got[42] and got[41] > got[40]
    if not head:  # no word has a token of its own: the two words' scores differ by their counts alone
        assert abs(got[41] - got[40] - np.log(42)) < 1e-4


def test_short_repeated_lines_go(spark):
    line, few = prose(1, 12), prose(2, 5)
    texts = [f"{line}\n{few}\nend one", f"start two\n{line}\n{few}\nend two", f"In {prose(3, 4)}. {line}. {prose(4, 4)}.", f"In {prose(5, 4)}. {line}. {prose(6, 4)}.", line]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in substring_dedup.substring_dedup_report(df).orderBy("doc_id").collect()]
    assert got == [texts[0], f"start two\n{few}\nend two", texts[2], texts[3], ""]


def thue_morse(a, b, n):
    """Two texts of n letters in which every polynomial hash with an odd base and modulus 2 ** 64 is the same from 1024 on."""
    s = a
    while len(s) < n:
        s += s.translate(str.maketrans({a: b, b: a}))
    return s, s.translate(str.maketrans({a: b, b: a}))


@pytest.fixture(scope="module")
def twins(spark):
    texts = [t for a, b in ("ab", "xy", "Q7", "éß") for n in (1024, 2048) for t in thue_morse(a, b, n)]
    sentences = [" ".join({"p": "one", "q": "two"}[c] for c in t) for t in thue_morse("p", "q", 1024)]
    texts += sentences + [f"{t} {x}" for t in texts[:4] for x in ("z", "zz")]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_structured_words_don_t_collide(twins, spark):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    texts, df = twins
    h = common.spans_hash(*[flat(texts)[k] for k in (0,)], flat(texts)[1][:-1], flat(texts)[1][1:])
    assert len(set(h.tolist())) == len(set(texts))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_path()), special_tokens={})
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.encode_decode_digests(df).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    counter = Tokenizer.from_file(token_counts.default_path())
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df).collect()} == {i: len(counter.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = {}
    for r in packing.packed_pieces(df).orderBy("doc_id", "piece").collect():
        crc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in crc[i]) and sum(n for _, n, _ in crc[i]) == len(ids)
    sets = [shingle_set(t) for t in texts]
    for r in ngram_join.ngram_components(df).collect():
        linked = [k for k in range(len(texts)) if 100 * len(sets[k] & sets[r["doc_id"]]) >= 80 * len(sets[k] | sets[r["doc_id"]])]
        assert r["n_shingles"] == len(sets[r["doc_id"]]) and r["component_id"] == min(linked)
    assert sorted((r["doc_id"], r["text"]) for r in substring_dedup.substring_dedup_report(df).collect()) == sorted(brute_repeats(list(enumerate(texts)), substring_dedup.MIN_WORDS))


def test_cached_strings_are_told_apart_by_their_bytes(monkeypatch):
    """With a hash of four values every lookup meets another string; results stay those of the libraries."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    weak = lambda buf, starts, ends, **_: (ends - starts).astype(np.uint64) % np.uint64(4) * np.uint64(2)
    texts = ["the cat sat on the mat", "a dog and a cat", "x" * 300, "x" * 299 + "y", "the end"]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_path()), special_tokens={})
    tokenizer, spec = Tokenizer.from_file(token_counts.default_path()), open(token_counts.default_path(), encoding="utf-8").read()
    whole = token_counts.whole_tokens(spec)
    for module in (byte_bpe, token_counts):
        monkeypatch.setattr(module, "spans_hash", weak)
    encoder = byte_bpe.Encoder(byte_bpe.Ranks(byte_bpe.read_ranks(byte_bpe.default_path())))
    for own in (texts, texts[::-1]):
        ids, at = encoder.encode(*flat(own))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [enc.encode_ordinary(t) for t in own]
    counter = token_counts.Counter(spec, whole)
    assert counter.counts(texts).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_workers_that_forget_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 30)
    encoder, plain = (byte_bpe.Encoder(byte_bpe.Ranks(byte_bpe.read_ranks(byte_bpe.default_path()))) for _ in range(2))
    for i in range(6):
        texts = [prose(i, 40), prose(i + 1, 3), ""]
        got = encoder.encode(*flat(texts))
        monkeypatch.setattr(byte_bpe, "KNOWN", 1000)
        expected = plain.encode(*flat(texts))
        monkeypatch.setattr(byte_bpe, "KNOWN", 30)
        assert got[0].tolist() == expected[0].tolist() and got[1].tolist() == expected[1].tolist()


def test_nodes_that_clash_are_told_apart():
    a, b = np.array([1, 2, 3], np.uint64), np.array([1, 2, 4], np.uint64)
    (node, check), other = ngram_join.node_of(a), ngram_join.node_of(b)
    assert node != other[0] and ngram_join.node_of(a, frozenset([node])) == (node ^ check, check)


def test_exact_lists_of_any_size(spark, monkeypatch):
    """A list is sent behind every few fingerprints; copies within a list, between lists and between partitions are met."""
    import pyarrow as pa

    from pyspark import TaskContext
    from types import SimpleNamespace

    monkeypatch.setattr(exact_dedup, "GATHERED", 4)
    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = ["a", "b", "a", "c", "d", "a", None, " ", "e", "f"]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 2)), pa.array(texts[i : i + 2], pa.string()), pa.array(range(i, i + 2))], ["doc_id", "text", "h"]) for i in range(0, 10, 2)]
    out = pa.Table.from_batches(list(exact_dedup._send(8)(batches))).to_pylist()
    rows, lists = [r for r in out if r["kind"] == 0], [r for r in out if r["kind"] == 1]
    assert len(rows) == 10 and len({r["row"] for r in rows}) == 10 and len({r["src"] for r in rows}) >= 2
    bitmaps = pa.Table.from_batches(list(exact_dedup._own([pa.RecordBatch.from_pylist([{k: r[k] for k in ("src", "owner", "payload")} for r in lists])]))).to_pylist()
    by = {(r["src"], r["owner"]): r["bitmap"] for r in bitmaps}
    both = pa.RecordBatch.from_pylist([{"src": r["src"], "payload": r["payload"], "again": r["again"], "bitmap": by[r["src"], r["owner"]]} for r in lists])
    met = {(r["src"], r["print"]) for b in exact_dedup._marked([both]) for r in b.to_pylist()}
    assert {r["doc_id"] for r in rows if (r["src"], r["print"]) in met} == {0, 2, 5, 6, 7}


def test_language_id_looks_at_a_batch_in_slices():
    import tracemalloc

    rnd = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnop qrst uv ", np.uint8)
    texts = [letters[rnd.integers(0, len(letters), 4000)].tobytes() for _ in range(1000)] + [b"", b"a", letters[rnd.integers(0, len(letters), 90_000)].tobytes()]
    buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    width = len(language_id.WIDTHS) * language_id.BUCKETS
    model = language_id.Model([f"l{i}" for i in range(200)], rnd.normal(size=(width, 200)).astype(np.float32), np.zeros(200), 1.0, 0.0)
    for whole, sliced in ((language_id.bags, language_id.bags_in_slices), (lambda b, o: language_id.logits(model, b, o), lambda b, o: language_id.logits_in_slices(model, b, o))):
        tracemalloc.start()
        got = sliced(buf, offs)
        kept, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert most - kept < 80e6  # a batch of 4 MB
        few = offs[:20]
        expected = whole(buf[: few[-1]], few)
        assert all(np.allclose(a, b) for x, y in zip(got[:19], expected, strict=False) for a, b in zip(np.atleast_1d(x), np.atleast_1d(y), strict=True)) if isinstance(got, list) else all(np.allclose(a[:19], b) for a, b in zip(got, expected, strict=True))
    for z, n in (language_id.logits_in_slices(model, buf[:0], np.zeros(k, np.int64)) for k in (1, 3)):
        assert len(z) == len(n) and np.isfinite(z).all()


def test_language_id_of_few_ids_and_none(spark):
    rows = [(7, f"das ist ein schöner text nummer {'abcdefghij'[i % 10]}", "de") for i in range(3000)] + [(7, f"this is a fine text of number {'klmnopqrst'[i % 10]}", "en") for i in range(3000)]
    got = language_id.language_predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")).groupBy("lang_pred").count().collect()
    held = zlib.crc32(b"7") % 4 == 2
    assert sum(r["count"] for r in got) == 6000 and ({r["lang_pred"] for r in got} == {"und"}) == held
    same = spark.createDataFrame([(1, "ein text wie jeder andere", "de")] * 50, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.language_predictions(same).collect()} == {"de"}
    bare = spark.createDataFrame([(1, "123 !", "de"), (3, "", "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.language_predictions(bare).collect()} == {"und"}
    many = spark.createDataFrame([(i, f"text {chr(97 + i % 26) * 3} words", f"l{i}") for i in range(700)], "doc_id long, text string, lang string")
    learned = {r["lang_pred"] for r in language_id.language_predictions(many).collect()}
    assert len(learned) <= language_id.MOST_LANGS


def test_language_scores_by_brute_force():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["Äpfel", "und", "the", "of", "x1y", "été", "--"]) for _ in range(rnd.randrange(9))) for _ in range(60)]
    model = language_id.fit(language_id.bags(*flat(texts)), ["a", "b", "c"] * 20)
    z, letters = language_id.logits(model, *flat(texts))
    for i, t in enumerate(texts):
        raw = bytes(c.lower().encode()[k] if c.isalpha() else 32 for c in t for k in range(len(c.encode())))
        assert letters[i] == sum(len(c.encode()) for c in t if c.isalpha())
        total, n = np.zeros(3), 0
        for k, width in enumerate(language_id.WIDTHS):
            for p in range(len(raw) - width + 1):
                gram = raw[p : p + width]
                if (gram.strip() == b"" or 32 in gram[1:-1]):
                    continue
                h = int.from_bytes(gram, "little") * 2654435761 & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0x85EBCA77 & 0xFFFFFFFF
                total, n = total + model.table[(h >> 18) + k * language_id.BUCKETS], n + 1
        assert np.allclose(z[i], total / max(n, 1) + model.bias, atol=1e-4)


def test_calibrated_threshold_is_a_quantile():
    model = language_id.Model(["a", "b"], np.zeros((1, 2), np.float32), np.zeros(2), 1.0, 0.0)
    rng = np.random.default_rng(0)
    z = rng.normal(0, 3, (4000, 2))
    language_id.calibrate(model, z, [["a", "b"][k] for k in z.argmax(1)], rejected=0.01)
    score = np.exp(z / model.temperature)
    score = (score / score.sum(1, keepdims=True)).max(1)
    assert 0.008 <= (score < model.least).mean() <= 0.01
    language_id.calibrate(model, z[:20], ["a"] * 20, rejected=0.01)
    assert 0 < model.least < 1


def test_articles_lose_nothing_by_names_that_are_no_chrome():
    body = "<section class='related-work'><p>A</p></section><div class=more-about>B</div><p class=tags-explained>C <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p><p class=ad>D</p>"
    chrome = "<div class='comments-list'>no</div><div class=ad-box>no</div><div id=cookie_notice>no</div><ul class='nav menu'><li>no</ul><div role=navigation>no</div>"
    assert html_wrappers.extract([f"<article>{body}{chrome}</article>"]) == ["A\nB\nC x=1\nD"]


def test_wrapper_of_many_labels_and_long_pages():
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    page = "<article>" + "".join(f"<div class=k{name(i)}>t{i}</div>" for i in range(140_000)) + "</article>"
    assert html_wrappers.extract([page]) == ["\n".join(f"t{i}" for i in range(140_000))]
    rnd = random.Random(1)
    pages = []
    for s in range(2):
        tags = [rnd.choice(["p", "h2", "div", "section", "pre"]) for _ in range(1500)]
        pages.append("<article>" + "".join(f"<{t} class=c{rnd.choice('abc')}>{s} {i}</{t}>" for i, t in enumerate(tags)) + "</article>")
    assert html_wrappers.extract(pages) == ["\n".join(f"{s} {i}" for i in range(1500)) for s in range(2)]


def test_folds_of_any_period():
    body = tuple(f"u{i}" for i in range(60))
    assert html_wrappers.fold(body * 3) == (("+", body),)
    assert html_wrappers.fold(tuple("abcbcbcd")) == ("a", ("+", ("b", "c")), "d")
    assert html_wrappers.fold(tuple("aabbaabb")) == (("+", (("+", ("a",)), ("+", ("b",)))),)


def test_fingerprints_by_brute_force(spark):
    """Bins, densification and packing against plain Python over the same shingle hashes."""
    texts = [prose(i, n) for i, n in enumerate((1, 4, 5, 9, 40, 300, 2000))] + ["", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    hashed = df.selectExpr("i", "t", r"filter(split(lower(trim(t)), '[\\x20\\x09-\\x0D]+'), w -> w <> '') as w")
    hashed = hashed.selectExpr("i", "case when size(w) = 0 then array() when size(w) < 5 then array(xxhash64(w)) else transform(sequence(1, size(w) - 4), k -> xxhash64(slice(w, k, 5))) end as h")
    h = {r["i"]: r["h"] for r in hashed.collect()}
    got = {r["i"]: r["f"] for r in fingerprints.with_fingerprint(df, "t", "f").withColumn("f", fingerprints.written("f")).collect()}
    start = [i * 0x9E3779B1 >> 11 & 255 for i in range(256)]
    step = [(i * 2654435761 >> 7) % 256 | 1 for i in range(256)]
    for i in range(len(texts)):
        if not h[i]:
            assert got[i] == ""
            continue
        bins = {}
        for x in h[i]:
            bins[(x >> 56) + 128] = min(bins.get((x >> 56) + 128, 1 << 70), x)
        low = []
        for b in range(256):
            at = b if b in bins else next((start[b] + step[b] * r) & 255 for r in range(1, 257) if (start[b] + step[b] * r) & 255 in bins)
            low.append(bins[at] & 255)
        assert got[i] == bytes(low).hex().upper()


def test_packing_terminates_and_numbers_are_unique(spark):
    sizes = [600] * 500 + [100] * 3 + [1023] * 20
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    out = packing.pack(items, group=100).collect()
    assert len({r["sequence_id"] for r in out}) == 520
    long = spark.createDataFrame([(1, "word " * 5000), (2, "a"), (3, "b " * 900)], "doc_id long, text string")
    rows = packing.packed_pieces(long).collect()
    assert all((r["sequence_id"] < 0) == (r["length"] == 1024) for r in rows)


def test_hot_keys_join_by_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i) for i in range(300) for k in (0, i)], "k int, v int")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("first")).where("n > 1")
    for hot in (2, 4096):
        monkeypatch.setattr(common, "HOT", hot)
        for how in ("inner", "left"):
            got = common.spread_join(rows, groups, ["k"], rows.count(), how)
            expected = rows.join(groups.drop("n"), "k", how)
            assert sorted(map(tuple, got.select("k", "v", "first").collect()), key=str) == sorted(map(tuple, expected.select("k", "v", "first").collect()), key=str)


def test_tables_need_a_shared_folder():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="yarn"))
    with pytest.raises(ValueError):
        common.shared_dir(spark)


@pytest.mark.parametrize("name", ["op5_ngram_jaccard_join", "op7_exact_dedup"])
def test_rows_equal_those_of_the_sql(spark, name):
    import duckdb

    from attestor.llm.queries import ORACLE_SQL, QUERIES

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    theirs = con.sql(ORACLE_SQL[name])
    ours = QUERIES[name](spark, folder).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(theirs.fetchall(), key=str)


#: A worker in small: three batches of 16 MB, of which nothing is kept; prints by how many MB its own memory has grown.
WORKER = """
import re
import pyarrow as pa
from attestor.llm import substring_dedup

def own():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def batches(n):
    for i in range(n):
        texts = pa.array(" ".join(f"w{(i * 8000 + j) * 257 + k}" for k in range(250)) + "." for j in range(8000))
        yield pa.record_batch([pa.array(range(8000)), pa.array(range(8000)), texts], ["rank", "h", "text"])

sum(b.num_rows for b in substring_dedup._units(b.slice(0, 1) for b in batches(1)))
before = own()
sum(b.num_rows for b in substring_dedup._units(batches(3)))
print(own() - before)
"""


@pytest.mark.skipif(not common._trim or not sys.platform.startswith("linux"), reason="what a process holds can't be told or returned here")
def test_workers_give_back_what_large_batches_took():
    run = subprocess.run([sys.executable, "-c", WORKER], capture_output=True, text=True, cwd=common.__file__.rsplit("/attestor/", 1)[0], check=True)
    assert float(run.stdout) < 4, run.stdout


def test_tasks_give_back_at_their_end_however_they_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.lean(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4] and calls == [1]
    stopped = common.lean(iter)([1, 2])
    next(stopped)
    stopped.close()
    assert calls == [1, 1]
    with pytest.raises(ZeroDivisionError):
        list(common.lean(lambda batches: (1 // b for b in batches))([0]))
    assert calls == [1, 1, 1]


def test_repeated_tokens_of_a_batch_take_little_memory(monkeypatch):
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 3_000_000, 1000, dtype=np.uint64)) for _ in range(2500)]
    monkeypatch.setattr(ngram_join, "_sets", lambda b, o, width: (sets[i] for i in range(len(o) - 1)))
    batch = pa.record_batch([pa.array(["x"] * len(sets))], ["text"])
    tracemalloc.start()
    got = list(ngram_join._repeated(5)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 2 and peak < 60e6, peak
    at, wanted = int(np.searchsorted(np.cumsum([len(x) for x in sets]), 2_000_000, "right")) + 1, []
    for part in (sets[:at], sets[at:]):
        tokens, counts = np.unique(np.concatenate(part), return_counts=True)
        wanted.append((tokens[counts > 1].tolist(), counts[counts > 1].tolist()))
    assert [(b.column(0).to_pylist(), b.column(1).to_pylist()) for b in got] == wanted
