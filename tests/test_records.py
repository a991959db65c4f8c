"""Record ends against a byte-by-byte walk, for any cut into blocks; rows of archives for any cut into ranges."""

import io
import random
import zipfile

import numpy as np
import pytest

from skein.sources import archives, records


def _walk(raw: bytes) -> list[bytes]:
    out, start, inside, i, fresh = [], 0, False, 3 if raw.startswith(records.MARK) else 0, True
    while i < len(raw):
        c = raw[i : i + 1]
        if inside:
            if c == b'"':
                if raw[i + 1 : i + 2] == b'"':
                    i += 1
                else:
                    inside = False
        elif c == b'"' and fresh:
            inside, fresh = True, False
        elif c in (b"\n", b"\r"):
            i += raw[i : i + 2] == b"\r\n"
            out.append(raw[start : i + 1])
            start, fresh = i + 1, True
        else:
            fresh = c == b","
        i += 1
    return [*out, raw[start:]] if start < len(raw) else out


def _fields(r: random.Random, broken: bool = False) -> bytes:
    plain = lambda: "".join(r.choice('ab é1"') for _ in range(r.randrange(4))).lstrip('"')
    quoted = lambda: '"' + "".join(r.choice(["a", ",", "\n", "\r", '""', "é", "\r\n"]) for _ in range(r.randrange(5))) + '"'
    return ",".join(r.choice([plain, quoted])() for _ in range(3)).encode()


@pytest.mark.parametrize("seed", range(20))
def test_record_ends_for_any_blocks(seed):
    r = random.Random(seed)
    raw = r.choice([b"", records.MARK]) + b"".join(_fields(r) + r.choice([b"\n", b"\r\n", b"\r"]) for _ in range(30)) + r.choice([b"", b"x,y,z"])
    want = _walk(raw)
    assert records.split_records(raw) == want and b"".join(want) == raw
    for size in (1, 2, 3, 7):
        scan = records.Scanner()
        ends = np.concatenate([*(scan.feed(raw[i : i + size]) for i in range(0, len(raw), size)), scan.finish()]).tolist()
        assert ends == np.cumsum([len(x) for x in want]).tolist() and scan.broken is None


def test_broken_members():
    with pytest.raises(ValueError):
        records.split_records(b'a\r\n"never closed')
    for raw, at in ((b'a,b\n"x"y,1\n', 7), (b"a,b\n\xff,1\n", 4)):
        scan = records.Scanner()
        scan.feed(raw)
        assert scan.broken == at
    assert records.split_records(b"") == []


@pytest.mark.parametrize("seed", range(4))
def test_ranges_of_members_give_the_rows_of_whole_ones(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 64)
    r = random.Random(seed)
    head = "p,q,r"
    bodies = {f"c/n{i}/a.csv": r.choice([b"", records.MARK]) + head.encode() + b"\r\n" + b"".join(_fields(r) + b"\r\n" for _ in range(r.randrange(40))) for i in range(4)}
    bodies |= {"c/n8/a.csv": b"other\n1\n", "c/n9/a.csv": b"", "c/n7/a.csv": head.encode() + b"\n1,2,3\n" + b"4,5,6\n" * 30 + b'7,"8"x,9\n1,2,3\n' * 20, "c/n6/a.csv": head.encode() + b"\n1,2,3\n\xff\xfe,1,2\n3,4,5\n", "c/n5/a.csv": head.encode() + b'\n1,2,3\n1,2\n"open,4,5\n'}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k, v in bodies.items():
            z.writestr(k, v)
    whole = {k: list(archives.read_range(io.BytesIO(v), head.split(","), 0, 1 << 60)) for k, v in bodies.items()}
    for k in [k for k in bodies if k[3] in "0123"]:
        assert whole[k] == list(archives.read_member(bodies[k], head.split(",")))
    assert [x[3] for x in whole["c/n7/a.csv"]] == [None] * 31 + ["FILE_FAILED"] and [x[3] for x in whole["c/n6/a.csv"]] == [None, "FILE_FAILED"] and [x[3] for x in whole["c/n5/a.csv"]] == [None, "WIDTH_MISMATCH", "FILE_FAILED"]
    assert [x[3] for x in whole["c/n8/a.csv"]] == [x[3] for x in whole["c/n9/a.csv"]] == ["HEADER_MISMATCH"]
    for size in (50, 333, 1 << 20):
        df = archives.read_archives(spark, [(tmp_path / "a.zip").as_uri()], {"a.csv": head.split(",")}, size)
        got = {}
        for row in sorted(df.collect(), key=lambda x: (x.member, x.data_row)):
            got.setdefault(row.member, []).append((row.data_row, row.names, row.fields, row.diagnostic))
        assert got == {k: v for k, v in whole.items() if v}
        assert df.rdd.getNumPartitions() >= sum(map(len, bodies.values())) // size


def test_written_archives_are_those_of_their_members(spark, tmp_path):
    import hashlib

    from skein.sinks import artifacts

    body = {f"c/n{i}/a.csv": b"p\n" + b"%d\n" % i * i for i in range(30)}
    rows = [("x.zip", k, bytearray(v)) for k, v in body.items()] + [("y.zip", "c/n/b.csv", bytearray(b"q\n1\n"))]
    made = {r.path.rpartition("/")[2]: r for r in artifacts.write_archives(spark.createDataFrame(rows, "archive string, member string, content binary"), tmp_path.as_uri()).collect()}
    raw = (tmp_path / "x.zip").read_bytes()
    assert made["x.zip"].n_members == 30 and made["x.zip"].sha256 == hashlib.sha256(raw).hexdigest() and sorted(p.name for p in tmp_path.iterdir()) == ["x.zip", "y.zip"]
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.namelist() == sorted(body) and {n: z.read(n) for n in z.namelist()} == body
    got = archives.read_archives(spark, [r.path for r in made.values()], {"a.csv": ["p"], "b.csv": ["q"]})
    assert got.where("diagnostic is null").count() == sum(range(30)) + 1
