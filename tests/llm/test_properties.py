"""Properties of the pure parts of the training-data operators on random input."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from plait.llm import census, jaccard_join, packing, repeated_phrases, secrets, text_density
from plait.llm.words import Words, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("abAB éß\t\n\x0b.,'1 日")), max_size=40)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    words = Words(pa.array(texts, pa.string()))
    assert [[words.text(i, i + 1).decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])] == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_slices_cover_in_order(texts, limit):
    column = pa.array(texts, pa.string())
    parts = list(slices(column, limit))
    assert [x for _, p in parts for x in p.to_pylist()] == texts and [r for r, _ in parts] == np.cumsum([0, *[len(p) for _, p in parts]])[:-1].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 5))
def test_windows_hold_every_token_once(sizes, limit):
    windows, full = packing.Windows(16, limit), []
    for key, n in enumerate(sizes):
        full += windows.add(key, np.arange(n, dtype="<u4").tobytes())
        assert len(windows.free) <= limit
    assert all(sum(len(p[2]) for p in w) == 64 for w in full)
    assert all(0 < sum(len(p[2]) for p in w) < 64 for w in windows.rest())
    seen = {}
    for key, start, data, total in (p for w in full + windows.rest() for p in w):
        assert np.frombuffer(data, "<u4").tolist() == list(range(start, start + len(data) // 4)) and total == sizes[key]
        seen[key] = seen.get(key, 0) + len(data) // 4
    assert seen == {k: n for k, n in enumerate(sizes)}


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6))
def test_tails_fit(n):
    parts = packing.tails(n, 4096)
    assert sum(parts) == n and all(p == 4096 or p & (p - 1) == 0 for p in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=80), st.integers(1, 50), st.sampled_from([3, 4, 8]))
def test_keys_travel(values, shards, width):
    keys = census.Keys(shards, width)
    codes = np.unique(keys.codes(np.array(values, np.uint64)))
    table = census.blobs(7, codes, np.ones(len(codes), np.int64), keys)
    mask = (1 << 8 * width) - 1
    assert [int(x) for blob in table.column("keys").to_pylist() for x in keys.unpack(blob)] == [int(c) & mask for c in codes]
    assert table.column("shard").to_pylist() == sorted(set(table.column("shard").to_pylist())) and all(0 <= s < shards for s in table.column("shard").to_pylist())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 100))
def test_prefix_reaches_every_partner(n, percent):
    need = jaccard_join.least_overlap(n, percent)
    assert 100 * need >= percent * n > 100 * (need - 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 3)), max_size=60, unique=True))
def test_runs_are_maximal_for_each_target(pairs):
    """What a target is sent covers its windows and nothing else, in runs that cannot be joined."""
    found = repeated_phrases.runs(np.array([p for p, _ in pairs], np.int64), np.array([t for _, t in pairs], np.int32), 3)
    for target in range(4):
        own = sorted((a, b) for a, b, to in found if target in to.tolist())
        assert {p for a, b in own for p in range(a, b - 2)} == {p for p, t in pairs if t == target}
        assert all(b - 2 < c for (_, b), (c, _) in zip(own, own[1:]))
    assert len({(a, b) for a, b, _ in found}) == len(found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=25), max_size=5), st.lists(st.lists(st.sampled_from("abcde"), min_size=5, max_size=14), max_size=4), st.integers(5, 30))
def test_located_words_lie_under_windows_of_passages(texts, passages, room):
    """Against every window of every text and passage, with few words and so many repetitions."""
    s = repeated_phrases.Settings(window=5, automaton_words=room)
    windows = {tuple(p[i : i + 5]) for p in passages for i in range(len(p) - 4)}
    raw = lambda rows: [[w.encode() for w in row] for row in rows]
    for text, gone in zip(texts, repeated_phrases.locate(raw(texts), raw(passages), s)):
        hits = [i for i in range(len(text) - 4) if tuple(text[i : i + 5]) in windows]
        assert [bool(g) for g in gone] == [any(i <= j < i + 5 for i in hits) for j in range(len(text))]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/apdivtr scple\"'=&;#!-hn")), max_size=200))
def test_any_page_has_a_text(html):
    got = text_density.main_text(html)
    assert isinstance(got, str) and got == got.strip()


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdef0123456789 AKI=:tokensecret'\"")), max_size=120))
def test_base_spans_equal_matches_with_short_ones_dropped(text):
    plain = []
    for n, (pattern, group, least, flags) in enumerate(((r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, re.I | re.A), (r"AKIA[A-Z0-9]+", 0, 20, 0), (r"[0-9a-f]+", 0, 24, 0))):
        plain += [(m.start(), n, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    assert [(s, secrets.KINDS[k], e) for k, s, e, _ in secrets.base_spans(text)] == sorted(plain)


def test_pieces_equal_the_tokenizer_on_odd_texts():
    """Random texts of letters, marks, digits, accents, other scripts and white space of all kinds."""
    import numpy as np
    import pyarrow as pa

    from plait.llm import packing as P
    from plait.llm.queries import tokenizer_path

    rng = np.random.default_rng(21)
    alphabet = list("abcdeABCDE  \t\n.,;:!?'\"-_()[]{}#*$%&|<>/\\@0123456789éÉñßÀøΣςабвЖ日本語😀\u00a0\u2003\u0085\u200b\u0301İıﬁ") + ["'s", "'ll", " the ", "</w>", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 30)))) for _ in range(4000)]
    encoder = P.Encoder(tokenizer_path(), P.Settings(cached_pieces=500))
    assert encoder.by_piece and encoder(pa.array(texts, pa.string())) == [encoder._whole(t) for t in texts]
