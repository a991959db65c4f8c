"""Packing of tokenised documents into sequences of equal cost."""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skein.llm import common

LENGTH = 2048
END_ID = 1
#: Tokens that are packed together; bounds the memory of a task.
GROUP = 1 << 22
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes without one take code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its ids, as the tokenizers library gives them with add_special_tokens=False.

    A byte-level vocabulary whose ids are its merge ranks is handed to tiktoken, which finds the same ids several
    times faster; any other, any text that holds an added token, and any on which tiktoken gives up, goes through tokenizers itself.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)

    def plain(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, before = said["model"], said.get("pre_tokenizer") or {}
    byte = _byte_of_char()
    vocabulary = {k: v for k, v in model.get("vocab", {}).items() if all(c in byte for c in k)} if isinstance(model.get("vocab"), dict) else {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ranked = [vocabulary.get("".join(m), -1) for m in merges]
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or said.get("normalizer") or not ranked or any(b <= a for a, b in zip(ranked, ranked[1:])):
        return plain
    import tiktoken
    from public_tokenizers import PATTERN

    added = sorted(a["content"] for a in said.get("added_tokens", []))
    special = set(added)
    ranks = {bytes(byte[c] for c in k): v for k, v in vocabulary.items() if k not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def quick(text: str) -> np.ndarray:
        if any(a in text for a in added):
            return plain(text)
        try:
            return np.array(fast.encode_ordinary(text), dtype=np.uint32)
        except Exception:  # noqa: BLE001  its regular expressions have a limit of their own
            return plain(text)

    return quick


def pack(sizes: np.ndarray, length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces of documents of ``sizes`` tokens: arrays of document, start, length, sequence, offset.

    Whole sequences are cut from documents that fill one.  The rest go, in descending order, each to the sequence
    of lowest cost among those with room; what has no room whole is cut into the gaps.  There are just so many
    sequences that none is padded: the last tokens make sequences of falling powers of two.
    """
    sizes = np.asarray(sizes, np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for doc in np.flatnonzero(sizes >= length):
        for i in range(int(sizes[doc]) // length):
            out.append((int(doc), i * length, length, sequence, 0))
            sequence += 1
    rest = sizes % length
    total = int(rest.sum())
    room = [length] * (total // length)
    room += [1 << b for b in range(length.bit_length() - 1, -1, -1) if (total % length) >> b & 1]
    size = list(room)
    open_ = [(0.0, i) for i in range(len(room))]
    full: list[tuple[int, float, int]] = []
    homeless = []
    for doc in np.lexsort((np.arange(len(rest)), -rest)):
        n = int(rest[doc])
        if not n:
            break
        while full and -full[0][0] >= n:
            _, cost, i = heapq.heappop(full)
            heapq.heappush(open_, (cost, i))
        while open_ and room[open_[0][1]] < n:
            cost, i = heapq.heappop(open_)
            if room[i]:
                heapq.heappush(full, (-room[i], cost, i))
        if not open_:
            homeless.append(int(doc))
            continue
        cost, i = heapq.heappop(open_)
        out.append((int(doc), int(sizes[doc]) - n, n, sequence + i, size[i] - room[i]))
        room[i] -= n
        if room[i]:
            heapq.heappush(open_, (cost + linear * n + quadratic * n * n, i))
    gaps = [i for _, i in sorted((c, i) for c, i in [*open_, *((c, i) for _, c, i in full)])]
    gap = iter(gaps)
    i = next(gap, None)
    for doc in homeless:
        n = int(rest[doc])
        while n:
            while not room[i]:
                i = next(gap)
            k = min(n, room[i])
            out.append((doc, int(sizes[doc]) - n, k, sequence + i, size[i] - room[i]))
            room[i] -= k
            n -= k
    return tuple(np.array(out, np.int64).reshape(-1, 5).T)


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens (a power of two): one row for each piece.

    Columns: doc_id, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.  A task
    tokenises its rows and packs them in groups of about ``group`` tokens, so nothing is shuffled.

    A null or empty text has the end id alone.  Repeated rows are packed each; a null doc_id stays null.  A very long
    text fills sequences of its own.  Documents of one size go in the order of their rows, and sequences of one cost in that of their numbers.  Other columns are not read.  An empty table gives an empty table.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    common.prepare(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        encode = encoder(vocabulary or default_vocabulary())
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 36
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0

        def flush():
            nonlocal number
            sizes = np.array([len(x) for x in ids], np.int64)
            doc, start, n, seq, offset = pack(sizes, length)
            for a in range(0, len(doc), 4096):
                c = slice(a, a + 4096)
                yield pa.record_batch({
                    "doc_id": pa.array([names[i] for i in doc[c]], pa.int64()),
                    "start": pa.array(start[c]),
                    "length": pa.array(n[c]),
                    "ids": pa.array([ids[i][s : s + k].tobytes() for i, s, k in zip(doc[c], start[c], n[c])], pa.binary()),
                    "doc_tokens": pa.array(sizes[doc[c]]),
                    "sequence_id": pa.array(seq[c] + number),
                    "offset": pa.array(offset[c]),
                })
            number += int(seq.max(initial=-1)) + 1

        for b in batches:
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                got = encode(text.as_py())
                ids.append(np.append(got, np.uint32(end_id)).astype("<u4"))
                names.append(name)
                held += len(ids[-1])
                if held >= group:
                    yield from flush()
                    ids.clear()
                    names.clear()
                    held = 0
        if ids:
            yield from flush()

    return common.texts(docs).mapInArrow(run, SCHEMA)
