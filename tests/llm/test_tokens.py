from __future__ import annotations

import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from reelmill.llm import token_store
from reelmill.llm.token_store import Encoding, Shard, encode, read_tokens, word_encoding, write_tokens
from tokenizers import Tokenizer

HOW = word_encoding()
ODD = ["a", "É", "É", "'s", "'S", "don't", "1", "22", "..", ",", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "Σ", "ΑΣ", "ß", " ", "\x1c",
       "\x85", "　", " ", "\n", "\x0b", "x.,", ".a", "İ", "K", "日本", "\U0001f600", "́", ".́", "'ll", "LL.", "I'M,"]


def test_encode_like_the_tokenizer():
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None]
    tokenizer = Tokenizer.from_file(HOW.tokenizer)
    found = [np.frombuffer(x, "<u2").tolist() for x in encode(pa.array(texts), HOW)]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    plain = Encoding(HOW.tokenizer)
    assert [np.frombuffer(x, "<u2").tolist() + [2] for x in encode(pa.array(texts), plain)] == found


@pytest.mark.parametrize("shard_bytes", [1, 4000, 8 << 20])
def test_round_trip(documents, prose, monkeypatch, shard_bytes):
    monkeypatch.setattr(token_store, "SHARD_BYTES", shard_bytes)
    rng = random.Random(4)
    texts = [(i, prose(rng.randint(0, 60))) for i in rng.sample(range(-500, 500), 120)] + [(None, "no id"), (600, None), (600, None)]
    manifest = write_tokens(documents(texts), HOW)
    rows = sorted(read_tokens(manifest).collect(), key=lambda r: (r.shard, r.place))
    tokenizer = Tokenizer.from_file(HOW.tokenizer)
    at = 0
    for row, (doc_id, text) in zip(rows, sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), crc)
        at += len(ids)
    last = manifest.orderBy("shard").collect()[-1]
    with Shard(last.path) as shard:  # one document alone, by the index
        assert shard.ids(shard.n_docs - 1).tolist()[-1] == 2
        assert shard.index["doc_id"][-1] == 600


def test_changed_dictionary_is_noticed(documents, prose):
    manifest = write_tokens(documents([(i, prose(200)) for i in range(60)]), HOW)
    path = manifest.first().path.removeprefix("file://")
    with Shard(path) as shard:
        name = shard.digest.hex()
    with open(f"{path.rpartition('/')[0]}/{name}.dict", "ab") as file:
        file.write(b"x")
    with pytest.raises(ValueError, match="another hash"):
        Shard(path)


def test_encoding_starts_no_threads():
    """Each thread of the tokenizer would keep memory of its own beside a task's."""
    code = ("import os, pyarrow as pa; from reelmill.llm.token_store import _loaded, encode, word_encoding; how = word_encoding();"
            "_loaded(how.tokenizer); threads = lambda: len(os.listdir('/proc/self/task')); before = threads();"
            "list(encode(pa.array([' '.join(f'word{i}x' for i in range(20000))]), how)); print(threads() - before)")
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": os.pathsep.join(sys.path)}
    assert subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout.strip() == "0"


def test_word_cache_is_bounded_by_its_ids(monkeypatch):
    """Few long words can hold as many ids as many short ones."""
    monkeypatch.setattr(token_store, "_tokenizers", {})
    monkeypatch.setattr(token_store, "CACHED_IDS", 5000)
    rng = random.Random(2)
    tokenizer, _, cache = token_store._loaded(HOW.tokenizer)
    for _ in range(6):
        text = " ".join("".join(rng.choice("abcxyz019") for _ in range(4000)) for _ in range(3))
        found = [np.frombuffer(x, "<u2").tolist() for x in encode(pa.array([text, text[:50]]), HOW)]
        assert found == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in (text, text[:50])]
        assert len(cache.pool) <= 5000 + 4000 * 3
