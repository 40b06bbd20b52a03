"""The operators' kernels, against plain versions of what they compute."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from catchment.llm import byte_bpe, html_text, jaccard_join, licenses, token_blocks, token_counts, toxicity

TEXTS = ["", " ", "a", "Hello  world\n\nagain", "x\ty\r\nz", "don't we'll", "aaaaaaaaaaaa", "日本語 テキスト　x", "é é ẛ̣", "🤗🤗 ok", "<|endoftext|> hi", "1234567", "\x1c\x85a", " lead and trail ", "word " * 300]


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        for top in (1, 2, 300, 49408, 2**32 - 1):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            if n:
                ids[rng.integers(0, n, n // 50 + 1)] = top - 1
            blocks, starts = token_blocks.pack_blocks(ids)
            assert (token_blocks.unpack_blocks(blocks, starts, n) == ids).all()


def test_segment_round_trip():
    ids = np.arange(10, dtype=np.uint32)
    docs, counts, back = token_blocks.unpack_segment(token_blocks.pack_segment([None, 7], [4, 6], ids))
    assert docs == [None, 7] and counts.tolist() == [4, 6] and (back == ids).all()
    with pytest.raises(ValueError):
        token_blocks.unpack_segment(b"nope")


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens_as_the_library(file):
    encoder = token_blocks.Encoder(P.path(file), keep=50)
    assert encoder.by_word == (file == "word_bpe_49k.json")
    rng = random.Random(8)
    some = [*"ab Éè'sl 12 ²½ªµß\x1c\x85\xa0\xad!?.-_~\t\n日ﬁ", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "'S", "e\u0301", "A\u030a", "Σ"]
    texts = [*TEXTS, "End. END! End... #. a_. x's. 12. É! <|ENDOFTEXT|>. <|endoftext|>. ΣΑΣ. İ. µ? ﬁ.", "x" * 5000, *("".join(rng.choice(some) for _ in range(rng.randrange(25))) for _ in range(2000))]
    want = [e.ids for e in encoder.tok.encode_batch(texts, add_special_tokens=False)]
    for lo, hi in token_blocks.slices(pa.array(texts), 3000):
        ids, counts = encoder.encode(pa.array(texts)[lo:hi])
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want[lo:hi]
    assert all(len(p) <= token_blocks.LONGEST for p in encoder.pieces.young)


def test_merge_replay_as_the_library():
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.Coder(path, P.PATTERN, keep=50)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab e\n é1,日\t\r\x1c\x85\xa0\u3000\x01's") for _ in range(rng.randrange(60))) for _ in range(3000)]
    for lo in range(0, len(texts), 37):
        ids, counts = coder.encode(pa.array(texts[lo : lo + 37]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want.encode_ordinary(t) for t in texts[lo : lo + 37]]
        flat, size = coder.decode(ids, counts)
        assert [x.tobytes().decode() for x in np.split(flat, np.cumsum(size)[:-1])] == texts[lo : lo + 37]


def test_lower_rank_goes_first(tmp_path):
    """A merge may create a pair of a lower rank than its own, which is then merged before the rest."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"bc"]
    file = tmp_path / "ranks"
    file.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    got = byte_bpe.Ranks(str(file)).replay([b"abcab", b"xabab", b"z"])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[256, 257], [120, 257, 257], [122]]


@pytest.mark.parametrize("spans", [1, 3, 64])
def test_short_words_are_replayed_together(tmp_path, monkeypatch, spans):
    """As a plain merge of each word's lowest pair, in whatever order ranks come; pairs are not looked up word by word."""

    class Counted(dict):
        n = 0

        def get(self, *a):
            Counted.n += 1
            return super().get(*a)

    def plain(rank, word):
        parts = [bytes([b]) for b in word]
        while found := min(((rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank), default=None):
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
        return [rank[x] for x in parts]

    monkeypatch.setattr(byte_bpe, "SPANS", spans)
    rng = random.Random(spans)
    for k in range(12):
        tokens = [bytes([b]) for b in range(256)] + sorted({bytes(rng.choices(b"abc", k=rng.randrange(2, 7))) for _ in range(50)}, key=lambda _: rng.random())
        if k % 3 == 0:
            rng.shuffle(tokens)
        file = tmp_path / f"ranks{k}"
        file.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % (i * (1 + 300 * (k % 2))) for i, t in enumerate(tokens)))
        ranks = byte_bpe.Ranks(str(file))
        ranks.pair, Counted.n = Counted(ranks.pair), 0
        words = sorted({bytes(rng.choices(b"abcd", k=rng.randrange(1, byte_bpe.SHORT + 1))) for _ in range(200)})
        got = [np.frombuffer(x, "<u4").tolist() for x in ranks.replay(words)]
        assert got == [[ranks.rank[w]] if w in ranks.rank else plain(ranks.rank, w) for w in words] and Counted.n == 0
        words = [bytes(rng.choices(b"abc", k=40)) for _ in range(5)]
        assert [np.frombuffer(x, "<u4").tolist() for x in ranks.replay(words)] == [plain(ranks.rank, w) for w in words] and Counted.n > 0


@pytest.mark.parametrize("text", [*TEXTS, "a" * 3000, " " * 3000, "日本" * 900, "ab c" * 900, "▁x y" * 500])
def test_spliced_counts(text):
    path = P.path("piece_bpe_32k.model")
    sp, _ = token_counts._model(path)
    assert token_counts.count_long(text, path, 200, 8) == len(sp.encode(text))


@pytest.mark.parametrize("text", ["x " + "=" * 60_000, "x " + "=" * 60_000 + " y z" * 9000, "ab c " * 5000 + "=" * 50_000])
def test_long_run_behind_a_word(text):
    path = P.path("piece_bpe_32k.model")
    sp, _ = token_counts._model(path)
    assert token_counts.count_long(text, path, 16_384, 512) == len(sp.encode(text))


def test_shingles_as_sets():
    def plain(t):
        w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "B", "ab", "É", "x y"]) for _ in range(rng.randrange(30))) for _ in range(200)]
    sets, hashes = [plain(t) for t in texts], [jaccard_join.shingles(t) for t in texts]
    for s, h in zip(sets, hashes, strict=True):
        assert len(s) == len(h)
    for a, b, x, y in zip(sets, sets[1:], hashes, hashes[1:], strict=False):
        assert len(a & b) == len(np.intersect1d(x, y))
    assert len(jaccard_join.shingles(None)) == 0 and jaccard_join.fingerprint(jaccard_join.shingles("")) == 0


def test_html():
    page = (
        '<html><head><title>No</title><script>var a="</p>";</script></head><body><nav><a href=/>Menu</a></nav><div class="cookie-notice">We use cookies.</div>'
        "<article><h1>A &amp; B</h1><p>One<b> two</b><br>three   four.<p>Five&nbsp;six &lt;x&gt;<ul><li>i<li>ii</ul><form>mail</form><div class='ad'>Buy</div>"
        "<section id=comments><p>First!</p></section></article><aside>More</aside><footer>&copy;</footer>"
    )
    assert html_text.main_text(page) == "A & B\n\nOne two three four.\n\nFive six <x>\n\ni\n\nii"
    assert html_text.main_text(page[: page.index("six &lt;") + 6]).endswith("Five six &l")
    assert html_text.main_text(None) == "" and html_text.main_text("") == ""
    long = "A sentence, with points; and more of them. " * 4
    free = f"<body><div id=menu><a href=1>x</a></div><div><p>{long}</p><p>{long}</p><p>Short, one.</p></div><ul><li><a href=2>link</a></li></ul><div>ok</div></body>"
    assert html_text.main_text(free) == "\n\n".join([long.strip(), long.strip(), "Short, one."])
    for cut in range(0, len(page), 7):
        html_text.main_text(page[:cut])


def test_html_scores_every_page():
    long = "A sentence, with points; and more of them. " * 4
    two = f"<p>{long}</p><p>{long}</p>"
    want = "\n\n".join([long.strip()] * 2)
    assert html_text.main_text(f"<body><div>{two}</div><article><h3>Card</h3><p>Read this.</p></article></body>") == want
    assert html_text.main_text(f"<body><article>{two}<div><a href=1>One more</a> <a href=2>Another</a></div></article></body>") == want
    assert html_text.main_text(f"<body><div class=has-sidebar>{two}<div class=ad>Buy, now.</div></div></body>") == want
    for name in ("article", "div"):
        assert html_text.main_text(f"<body><nav><a href=1>x</a></nav><{name}><h1>T</h1>{two}</{name}><footer>&copy; A, b.</footer></body>") == f"T\n\n{want}"


def test_licences():
    scan = lambda t: licenses.match(licenses.identify(t, {licenses.normalise(s): i for i, s in licenses.SENTENCES.items()}, {}), licenses.RULES)
    s = licenses.SENTENCES
    assert scan("Text.\nReleased under the MIT License.\nmore") == ["MIT"]
    assert scan("LICENSED under the   Apache License, version 2.0") == ["Apache-2.0"]
    assert scan("\n".join(s[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))) == ["BSD-3-Clause"]
    assert scan("\n".join(s[k] for k in ("bsd-grant", "bsd-source", "bsd-binary"))) == ["BSD-2-Clause"]
    assert scan("\n".join([s["bsd-grant"], "something else", s["bsd-source"], s["bsd-binary"]])) == []
    assert scan("\n".join(s[k] for k in ("bsd-source", "bsd-grant", "bsd-binary"))) == []
    assert scan(None) == [] and scan("") == []


def test_wrapped_and_numbered_licences():
    import textwrap

    known = {licenses.normalise(s): i for i, s in licenses.SENTENCES.items()}
    scan = lambda t: licenses.match(licenses.identify(t, known, licenses.by_first_word(known)), licenses.RULES)
    s = licenses.SENTENCES
    for name, seq in licenses.RULES:
        for mark in ("", "# ", " * ", "// "):
            for width in (30, 50, 78):
                one = textwrap.fill(" ".join(s[k] for k in seq), width)
                each = "\n".join(textwrap.fill(s[k], width) for k in seq)
                for t in (one, each):
                    t = f"code\n\nCopyright (c) 2020 A. Name\nAll rights reserved.\n\n{t}\n\nmore"
                    assert scan("\n".join(mark + x for x in t.split("\n"))) == [name], (name, mark, width, t)
    clauses = [s[k] for k in ("bsd-source", "bsd-binary", "bsd-names")]
    for form in ("{}. ", "{}) ", "({}) "):
        for marks in ("123", "abc"):
            wrapped = [textwrap.fill(form.format(m) + c, 60, subsequent_indent="   ") for m, c in zip(marks, clauses, strict=True)]
            assert scan("\n".join([textwrap.fill(s["bsd-grant"], 60), "", *wrapped])) == ["BSD-3-Clause"]
            assert scan("\n".join([s["bsd-grant"], *wrapped[:2], "Something else."])) == ["BSD-2-Clause"]
            assert scan(" ".join([s["bsd-grant"], *(form.format(m) + c for m, c in zip(marks, clauses, strict=True))])) == ["BSD-3-Clause"]
    assert scan("\n".join([s["mit-grant"], "(c) 2019 B", s["mit-notice"]])) == ["MIT"]
    assert scan("\n".join([s["mit-grant"], "In 2019 B", s["mit-notice"]])) == []
    assert scan("Copyright 2020 C. Released under the MIT License.") == ["MIT"]


def test_tags_and_full_texts():
    known = {licenses.normalise(s): i for i, s in licenses.SENTENCES.items()}
    tags = licenses.tag_names(known)
    scan = lambda t: licenses.match(licenses.identify(t, known, licenses.by_first_word(known), tags), licenses.RULES)
    for mark, end in (("", ""), ("# ", ""), ("/* ", " */"), ("<!-- ", " -->")):
        tag = lambda x: scan(f"first line\n{mark}SPDX-License-Identifier: {x}{end}\nint main() {{}}\n")  # noqa: E731, B023
        for name in licenses.TAGS:
            assert tag(name) == [name]
        assert tag("Apache-2.0 OR MIT") == ["Apache-2.0", "MIT"]
        assert tag("(MIT-0 AND (MIT or BSD-3-Clause)) OR GPL-2.0-or-later WITH Classpath-exception-2.0") == ["MIT-0", "MIT", "BSD-3-Clause", "GPL-2.0-or-later"]
        assert tag("GPL-2.0 WITH Linux-syscall-note OR MIT") == ["GPL-2.0-only", "MIT"]
        assert tag("LGPL-2.1+") == ["LGPL-2.1-or-later"] and tag("GPL-3.0+ AND MIT") == ["GPL-3.0-or-later", "MIT"]
        assert tag("MIT OR LicenseRef-own") == ["MIT"] and tag("LicenseRef-own OR MIT") == [] and tag("") == []
    assert scan("SPDX-License-Identifier:MIT") == ["MIT"]
    assert scan("SPDX-License-Identifier: Apache-2.0\nor something else") == ["Apache-2.0"]
    assert scan("SPDX-License-Identifier: Apache-2.0 OR\n# MIT\nReleased under the MIT License.") == ["Apache-2.0", "MIT", "MIT"]
    assert scan("SPDX-License-Identifier: MIT Permission") == ["MIT"] and scan("SPDX-License-Identifier:") == []
    apache = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document.

      "Licensor" shall mean the copyright owner or entity authorized by"""
    assert scan(apache) == ["Apache-2.0"]
    gpl = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.
"""
    assert scan(gpl) == ["GPL-3.0-only"]
    assert scan("Mozilla Public License Version 2.0\n====\n\n1. Definitions\n---\n") == ["MPL-2.0"] and scan("The Mozilla Public License Version 2.0 is one.") == []


def test_label_model_and_classifier():
    rng = np.random.default_rng(2)
    y = rng.random(3000) < 0.15
    votes = ((rng.random((3000, 12)) < 0.4) & y[:, None]).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # a voter that repeats another
    post = toxicity.label_model(votes)
    seen = votes.any(axis=1)
    assert (post[seen] > 0.5).all() and (post[~seen] < 0.5).all()
    w = toxicity.linear_model(votes, post)
    assert (((votes @ w[:-1] + w[-1]) > 0) == seen).all()


def test_label_model_knows_repeats_and_both_sides():
    """Twelve voters that repeat one unreliable voter count as that one; a voter against weighs as such."""
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.2
    good = ((rng.random((6000, 4)) < 0.5) & y[:, None]) | (rng.random((6000, 4)) < 0.01)
    noisy = (rng.random(6000) < np.where(y, 0.3, 0.15))[:, None]
    clean = ((rng.random((6000, 2)) < 0.5) & ~y[:, None]) | (rng.random((6000, 2)) < 0.02)
    votes = np.hstack([good, np.repeat(noisy, 12, axis=1), clean]).astype(float)
    post = toxicity.label_model(votes, against=np.array([False] * 16 + [True] * 2), share=0.2)
    right = (post > 0.5) == y
    alone = noisy[:, 0] & ~good.any(axis=1) & ~clean.any(axis=1)
    # Voters taken as independent would be sure of the twelve repeats, and wrong in seven of eight cases.
    assert right.mean() > 0.87 and alone.sum() > 100 and (post[alone] < 0.5).all()
    assert (post[clean.any(axis=1) & ~good.any(axis=1) & ~noisy[:, 0]] < 0.2).all()


def test_voters_and_shapes():
    assert {"#exclaims", "#shouts", "you", "you fool", "foolis-"} <= toxicity.evidence("YOU FOOL!! THE FOOLISHNESS ENTERS") and not toxicity.shapes("a. b!")
    judge = toxicity._judge({"you fool": 4.0, "clow-": 2.0, "#exclaims": 1.0, "idiot": 3.0}, -2.0)
    z = [float(np.log(p / (1 - p))) for p in judge(pa.array(["You, fool", "fool you", "clowns!!", "an idiot", None]))]
    assert np.allclose(z, [2, -2, 1, 1, -2])
