"""Each operator against a plain version of its rule."""

import bisect
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from compare import assert_same, connect
from fieldspark.llm import chat, decontam, langid, lines, packing, quality, simhash, token_counts, urls
from fieldspark.llm.oracle import ORACLE
from fieldspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF), connect(SF).sql(ORACLE[name]))


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = QUERIES["op1_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)


def test_mixed_text_has_spans(spark, docs):
    model = langid.train(docs)
    en = "the cat and the thing with that other thing for the being of this nation "
    de = "der hund und die katze sind nicht einfach auf der heiterkeit schreibung "
    df = spark.createDataFrame([(1, en * 3 + de * 3)], "doc_id long, text string")
    row = langid.label(df, model).first()
    assert [s.lang for s in row.spans] == ["en", "de"]
    assert abs(row.spans[1].start - 3 * len(en)) < 40 and row.spans[0].end == row.spans[1].start


def plain_label(m, text):
    """Prediction and score, word by word and n-gram by n-gram, with the whole chain."""
    words = [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if w.isalpha()]
    if not words:
        return "und", 0.0
    mask, paths = (1 << 64) - 1, {x: (m.prior[x], ()) for x in range(len(m.languages))}
    for at, word in enumerate(words):
        codes = [2, *map(ord, word), 2]
        total = np.zeros(len(m.languages))
        for k in (1, 2, 3, 4):
            for i in range(len(codes) - k + 1):
                run = codes[i : i + k]
                if run == [2] or 2 in run[1:-1]:
                    continue
                h = 0
                for size, c in enumerate(run, 1):
                    h = (h * 0x9E3779B97F4A7C15 & mask) ^ (c + size)
                total += m.table[(h * 0xFF51AFD7ED558CCD & mask) >> 40 & (langid.BUCKETS - 1)]
        able = m.scripts.get(langid.script_of(word[0]), range(len(m.languages)))
        top = max(paths, key=lambda x: paths[x][0])
        step = {}
        for x in able:
            stay = paths.get(x, (-np.inf, ()))
            move = (paths[top][0] - m.switch_cost, paths[top][1])
            best = move if at and move[0] > stay[0] else stay
            step[x] = (best[0] + total[x], (best[1], x))
        paths = step
    path, letters = max(paths.values(), key=lambda p: p[0])[1], [0] * len(m.languages)
    for word in reversed(words):
        path, x = path
        letters[x] += len(word)
    return m.languages[int(np.argmax(letters))], max(letters) / sum(letters)


def test_language_against_the_plain_chain(spark, docs, texts):
    model = langid.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op1_language_id"](spark, SF).collect()}
    for doc_id, text in texts.items():
        want = plain_label(model, text)
        assert got[doc_id][0] == want[0] and np.isclose(got[doc_id][1], want[1]), doc_id


def test_language_eviction_changes_nothing(docs, monkeypatch):
    model = langid.train(docs)
    some = [r.text for r in docs.orderBy("doc_id").limit(60).collect()]
    want = langid.label_texts(model, some)
    monkeypatch.setattr(langid, "KEPT", 50)
    monkeypatch.setattr(langid, "LONG", 6)
    monkeypatch.setattr(langid, "LONG_LETTERS", 100)
    model.index, model.scores, model.hits = {}, None, None
    assert langid.label_texts(model, some, group=40) == want


def test_other_scripts_are_no_candidates():
    table = np.zeros((langid.BUCKETS, 2), np.float32)
    table[:, 0] = -20  # the only language of Cyrillic is a bad match for everything
    model = langid.Model(["ru", "en"], table, np.zeros(2), {"Cyrillic": np.array([0]), "Latin": np.array([1])})
    long = "невероятнодлинноеслово" * 5
    (one, two, three) = langid.label_texts(model, [long, f"some english words {long} and more", "123 ½ ²"])
    assert one[:2] == ("ru", 1.0) and three == ("und", 0.0, [])
    assert [(s["lang"], s["start"]) for s in two[2]] == [("en", 0), ("ru", 19), ("en", 20 + len(long))]
    assert np.isneginf(model.score([long])[0, 1]) and np.isfinite(model.score(["ไทย"])).all()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 6, 4)
        scores = rng.normal(size=(lengths.sum(), 3)) * 3
        path = langid.viterbi(scores, lengths, np.zeros(3), 2.0)
        at = 0
        for n in lengths:
            s = scores[at : at + n]
            value = lambda p, s=s: sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
            assert np.isclose(value(path[at : at + n]), max(value(p) for p in np.ndindex(*[3] * n)))
            at += n


def plain_ids(text):
    from tokenizers import Tokenizer

    plain_ids.t = getattr(plain_ids, "t", None) or Tokenizer.from_file(packing.vocabulary("word_bpe_49k.json"))
    return plain_ids.t.encode(text, add_special_tokens=False).ids


def test_packing(spark, texts):
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = [*plain_ids(text or ""), 1]
        want = [(i, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), 4096)) for p in [ids[s : s + 4096]]]
        assert sorted(got[doc_id]) == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    tokens = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * tokens / 4096 + 2
    assert len(sequences) == plain_best_fit([r.length for r in rows], 4096)


def plain_best_fit(lengths, size):
    """How many sequences best-fit decreasing takes, piece by piece."""
    left = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(left, length)
        room = left.pop(at) if at < len(left) else size
        bisect.insort(left, room - length)
    return len(left)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12), st.integers(40, 60))
def test_plan_places_every_piece_once(histogram, size):
    plan = packing.best_fit_plan(histogram, size)
    assert len({seq + rank // each for _, lo, hi, seq, each, _ in plan for rank in range(hi - lo)}) == plain_best_fit([x for x, n in histogram.items() for _ in range(n)], size)
    placed, room = defaultdict(int), defaultdict(list)
    for length, lo, hi, seq, each, base in plan:
        placed[length] += hi - lo
        for rank in range(hi - lo):
            room[seq + rank // each].append((base + rank % each * length, length))
    assert placed == histogram
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aéẞßİΣ'’12 \n\t.,!\u00a0\u0301\u1e9b<|endoftext|>x中\x1c\x85"), max_size=60))
def test_word_tokenizer_is_the_library(text):
    got = packing.word_tokenizer(packing.vocabulary("word_bpe_49k.json")).encode(text)
    assert np.frombuffer(got, "<u4").tolist() == plain_ids(text)


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(spark, texts):
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    ids = sorted(fps)
    want = components(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SF).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in ids}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 7])
@pytest.mark.parametrize("n_blocks", [6, 7])
def test_simhash_links(spark, monkeypatch, bucket, n_blocks):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for c in list(fps)[:4]:
        for _ in range(40):
            x = c
            for _ in range(rng.randint(1, 9)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    want = components(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    signed = {f: f - (1 << 64 if f >> 63 else 0) for f in fps}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    edges = [(r.src, r.dst) for r in simhash.link_fingerprints(df, 4, n_blocks).collect()]
    back = {v: k for k, v in signed.items()}
    assert components(fps, [(back[a], back[b]) for a, b in edges]) == want


def test_components_of_a_long_path(spark):
    from fieldspark.llm.common import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 200), (200, 500), (300, 300)], "src long, dst long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(101)} | {200: 200, 500: 200}


def test_components_with_many_nodes_and_hubs(spark, monkeypatch):
    """The shuffle join of the ordinary nodes and the broadcast one of hubs, which only large graphs reach."""
    from fieldspark.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(common, "HUB_ROWS", 5)
    rng = random.Random(4)
    pairs = [(1000, i) for i in range(40)] + [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(45)] + [(3000 + i, 3001 + i) for i in range(9)]
    want = components({x for p in pairs for x in p}, pairs)
    got = {r.node: r.label for r in common.connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {n: c for n, c in want.items() if n in got} and {n for n, c in want.items() if sum(x == c for x in want.values()) > 1} == set(got)


def test_token_counts(spark, texts):
    path = packing.vocabulary("piece_bpe_32k.model")
    model = token_counts.tokenizer(path)
    given = Counter(i for t in texts.values() for w in (t or "").encode().split() for i in model.encode(w.decode()))
    pieces = token_counts.piece_scores(path, given)
    trie = token_counts.ForwardTrie(pieces)
    longest = max(map(len, pieces))

    @cache
    def plain(word):
        text = token_counts.START + word
        best = [(0.0, 0)]
        for d in range(1, len(text) + 1):
            n = len(text[d - 1].encode())
            options = [(best[d - 1][0] + n * trie.byte_score, best[d - 1][1] + n)]
            options += [(best[i][0] + pieces[text[i:d]], best[i][1] + 1) for i in range(max(0, d - longest), d) if text[i:d] in pieces]
            best.append(max(options, key=lambda o: (o[0], -o[1])))
        return best[-1]

    got = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    assert len(got) == len(texts)
    for doc_id in texts:
        words = (texts[doc_id] or "").encode().split()
        want = [plain(w.decode()) for w in words]
        assert (got[doc_id].n_words, got[doc_id].n_tokens) == (len(words), sum(c for _, c in want))
        assert np.isclose(got[doc_id].score, sum(s for s, _ in want))


def test_terminals_of_two_generations(monkeypatch):
    pieces = {"▁a": -1.0, "▁": -3.0, "b": -2.0, "ab": -2.5, "a": -4.0}
    words = [["a", "ab", "b"], ["bb", "aab"], ["ab", "c"], ["b", "a", "bb"], ["ab"]]
    whole = token_counts.ForwardTrie(pieces)
    whole.insert({w for ws in words for w in ws})
    monkeypatch.setattr(token_counts, "TERMINALS", 2)
    trie = token_counts.ForwardTrie(pieces)
    for ws in words:
        trie.insert(set(ws))
        assert [trie.terminal[w] for w in ws] == [whole.terminal[w] for w in ws] and len(trie.terminal) < 7


def test_policies_and_ablations(spark, docs):
    led = quality.ledger(docs).cache()
    rows = led.collect()
    bits = {r.name: 1 << r.bit for r in quality.RULES}
    for r in quality.ablations(led).collect():
        mask = quality.mask_of(quality.POLICIES[r.policy])
        assert r.rejected == sum(bool(x.fail_bits & mask) for x in rows)
        assert r.only_rule == sum(x.fail_bits & mask == bits[r.rule] for x in rows)
    kept = quality.apply_policy(led, "base").where("kept").count()
    assert kept == sum(not x.fail_bits & 3 for x in rows)


def test_url_odds_beyond_the_seeds(spark):
    """Words that stand beside seed words block without them; a hidden seed with nothing beside it doesn't."""
    rows = [f"https://casino-bonus{i}.net/roulette/{i}" for i in range(40)] + [f"https://green-garden{i}.net/tools/{i}" for i in range(80)]
    rows += ["https://bonus-roulette.net/roulette/1", "https://garden-tools.net/green/1", "https://poker7.net/tools/1"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(df, rules=(urls.Rule("allow", "none.example", "/"),), seeds=("casino",)).collect()}
    assert [got[i] for i in range(120)] == ["block"] * 40 + ["allow"] * 80
    assert [got[i] for i in range(120, 123)] == ["block", "allow", "allow"]


def test_url_rules(spark):
    got = QUERIES["op7_url_filters"](spark, SF).collect()
    url = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got:
        rest = (url[r.page_id] or "").partition("://")[2]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        fits = [x for x in urls.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best.text)
        assert r.verdict == (best.verdict if best else "block" if r.score > 0 else "allow")
    bad = [r for r in got if r.rule is None and re.search("casino|bets|spam|adult|pills", r.host)]
    assert bad and all(r.verdict == "block" for r in bad)


def test_url_bayes_and_segments_over_all_pages(spark):
    """Every token and score, from plain counts of the whole table."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    parts = lambda url: re.match(r"([^/?#]*)([^?#]*)", (url or "").partition("://")[2]).groups()
    counts = Counter()
    for r in pages:
        heads = " ".join(x[1] for x in re.findall(r"(?is)<(title|h1)[^>]*>(.*?)</(?:title|h1)>", r.html or ""))
        counts.update(w for w in re.split(r"[\W\d_]+", f"{parts(r.url)[1]} {heads}".lower()) if 2 <= len(w) <= urls.MAX_WORD)
    mean = max(1, sum(counts.values()) // len(counts))
    for w in urls.SEEDS:
        counts[w] = max(counts[w], mean)
    total = sum(counts.values())
    logp = {w: math.log(n / total) for w, n in counts.items()}
    tokens = {}
    for r in pages:
        host, path = parts(r.url)
        tokens[r.page_id] = [
            f"{where}:{w}" for where, text in (("h", host.lower()), ("p", path.lower())) for x in re.findall(r"[^\W\d_]+|\d+", text)
            for w in (["#"] if x[0].isdigit() else urls.best_split(x, logp, -math.log(total + 1) - 2.0))
        ]
    bad, good, n_bad = Counter(), Counter(), 0
    for ts in tokens.values():
        blocked = any(t[2:] in urls.SEEDS for t in ts)
        n_bad += blocked
        (bad if blocked else good).update(ts)
    size = len(bad.keys() | good.keys()) + 1
    odds = lambda t: math.log((bad[t] + 1) / (bad.total() + size)) - math.log((good[t] + 1) / (good.total() + size))
    prior = math.log((n_bad + 1) / (len(tokens) - n_bad + 1))
    got = {r.page_id: r for r in QUERIES["op7_url_filters"](spark, SF).collect()}
    assert len(got) == len(tokens)
    for page_id, ts in tokens.items():
        assert got[page_id].tokens == ts
        assert abs(got[page_id].score - prior - sum(map(odds, ts))) < 1e-6
        assert got[page_id].rule or (got[page_id].verdict == "block") == (prior + sum(map(odds, ts)) > 0)


def test_segmentation_is_the_best_split(spark):
    rows = [("free", 5), ("casino", 3), ("win", 4), ("wins", 1), ("in", 9)]
    logp = {w: math.log(n / 22) for w, n in rows}
    assert urls.best_split("freecasinowin", logp, -5.0) == ["free", "casino", "win"]
    assert urls.best_split("", logp, -5.0) == [] and urls.best_split("zz", logp, -5.0) == ["zz"]
    names = spark.createDataFrame([("freecasino" * 30,), ("winsin",), ("x",), ("winsin",)], "name string")
    got = {r.name: r.words for r in urls.segments(names, spark.createDataFrame(rows, "w string, n long")).collect()}
    assert got == {"freecasino" * 30: ["free", "casino"] * 30, "winsin": ["wins", "in"], "x": ["x"]}


def test_long_and_repeated_urls(spark):
    long = "http://" + "a" * 5000 + ".example.com/" + "freebets" * 500
    rows = [(1, long, None), (2, long, "<title>free</title>"), (2, None, None), (3, "no scheme", ""), (None, "http://x.net/casino", "")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.host[:3]) for r in got) == [(0, "x.n"), (1, "aaa"), (2, ""), (2, "aaa"), (3, "")]
    assert len({(tuple(r.tokens), r.score, r.verdict) for r in got if r.host[:1] == "a"}) == 1
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("max_bytes,confirmed", [(1 << 25, lines.CONFIRMED), (1 << 25, 0), (1, 0), (1, lines.CONFIRMED)])
def test_line_dedup_is_exact_whatever_the_filter(spark, docs, texts, monkeypatch, max_bytes, confirmed):
    monkeypatch.setattr(lines, "CONFIRMED", confirmed)
    keys = {d: [x.strip(b" \t\n\x0b\x0c\r") for x in (t or "").encode().lower().split(b"\n")] for d, t in texts.items()}
    held = defaultdict(set)
    for d, ks in keys.items():
        for k in ks:
            if len(k.decode()) >= 20:
                held[k].add(d)
    shared = {k: max(ds) for k, ds in held.items() if len(ds) >= 3}
    got = {r.doc_id: r for r in lines.line_dedup(docs, bits_per_line=1, max_filter_bytes=max_bytes).collect()}
    for d, t in texts.items():
        kept = [x for x, k in zip((t or "").split("\n"), keys[d], strict=True) if shared.get(k, d) == d]
        assert got[d].text == "\n".join(kept) and got[d].line_count == len(keys[d]) and got[d].line_dropped == len(keys[d]) - len(kept)


def test_leaks_in_small_edits(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((5, 9, 30, 60, 200))))) for i in range(40)]
    rows = []
    for i, (_, text) in enumerate(items):
        w = text.split()
        if i % 3 == 1:
            w[len(w) // 2] = "changed"
        rows.append((i, " ".join([*rng.choices(words, k=300), *w, *rng.choices(words, k=300)]).upper()))
    sh = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    want = {(d, i) for d, t in rows for i, x in items if len(sh(t.lower()) & sh(x)) >= 0.8 * len(sh(x))}
    got = decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 30


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("\\<|>/s[INST] \nok"), max_size=40))
def test_escape_is_reversible_and_hides_control(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)


def test_templates():
    run = lambda t, ms=(): "".join(x for x, _ in chat.compile_template(t)(ms))
    ms = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]
    assert run("{% for m in messages %}{% if loop.first %}^{% elif m.role != 'user' %}-{% else %}?{% endif %}{{ m['text']|upper }}{% endfor %}", ms) == "^A-B"
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 + 1 }}{% if not false %}c{% else %}{{ x }}{% endif %}")) == (chat.Output(chat.Const("ab2c")),)
    assert list(chat.compile_template("{% generation %}x{% endgeneration %}y")(())) == [("x", True), ("y", False)]
    for bad in ("{{ a.__class__ }}", "{{ f(1) }}", "{% import x %}", "{% if a %}", "{{ a|nope }}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    with pytest.raises(chat.TemplateError):
        run("{{ messages.append }}", ms)


def test_pipeline_stages(spark, docs, texts):
    now = docs
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).cache()
        assert now.columns == docs.columns
        kept.append({r.doc_id: r.text for r in now.collect()})
    lang, deduped, unique, clean = kept
    assert lang.items() <= texts.items() and all(re.search(r"[^\W\d_]", t or "") for t in lang.values())
    assert len(lang) >= 0.98 * sum(bool(re.search(r"[^\W\d_]", t or "")) for t in texts.values())
    held = defaultdict(set)
    for d, t in lang.items():
        for x in (t or "").encode().lower().split(b"\n"):
            if len(x.strip().decode()) >= 20:
                held[x.strip()].add(d)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 3}
    assert deduped == {d: "\n".join(x for x in t.split("\n") if gone.get(x.strip().encode().lower(), d) == d) for d, t in lang.items()}
    split = {d: (t or "").encode().lower().split() for d, t in deduped.items()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, w in split.items()}
    alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    part = components(sorted(sets), [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])])
    assert unique == {d: t for d, t in deduped.items() if part[d] == d}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    sh = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    items = [sh(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean == {d: t for d, t in unique.items() if not any(i and len(i & sh(words(t))) >= 0.8 * len(i) for i in items)}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(clean)
    total = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert all(r.n == len(plain_ids(clean[r.doc_id])) + 1 for r in total)


def test_chat_round_trip(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    for r in QUERIES["op10_chat_formatting"](spark, SF).collect():
        own = turns.get(r.conv_id) or [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
        said = "".join(t for role, t in own if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(own), len(said), hashlib.sha256(said.encode()).hexdigest())
