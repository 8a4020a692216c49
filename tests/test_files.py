"""First lines and tree digests of files."""

import hashlib
import os
import shutil

from reelsight.sources import files as fl
from reelsight.sources.readers import load_table


def test_first_lines_read_no_more(spark, tmp_path):
    texts = {"a.csv": b"x,y\n1,2\n", "b.csv": b"\xef\xbb\xbfX ,y\r\n3,4\r\n", "c.csv": b"no,end", "d.csv": b"", "e.csv": b"h" * 30_000 + b"\n1\n",
             "f.csv": b"z\n" + b"row\n" * 1_000_000, "n/g h.csv": b"x,y\n5,6\n"}
    os.makedirs(tmp_path / "n")
    for n, t in texts.items():
        (tmp_path / n).write_bytes(t)
    got = {r["path"].split(str(tmp_path) + "/")[1]: r["line"] for r in fl.first_lines(fl.files(spark, str(tmp_path), "*.csv")).collect()}
    assert got == {"a.csv": "x,y", "b.csv": "X ,y", "c.csv": "no,end", "e.csv": "h" * 30_000, "f.csv": "z", "n/g h.csv": "x,y"}
    some = fl.first_lines(fl.files(spark, str(tmp_path), "e.csv"), longest=10_000).first()["line"]
    assert some == "h" * 10_000
    for n in ("c.csv", "d.csv", "e.csv", "f.csv"):
        os.remove(tmp_path / n)
    rows = load_table(spark, [str(tmp_path)]).collect()
    assert sorted((r["x"], r["y"]) for r in rows) == [("1", "2"), ("3", "4"), ("5", "6")]


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def tree(leaves, fan):
    while True:
        leaves = [sha(",".join(leaves[i:i + fan])) for i in range(0, len(leaves), fan)]
        if len(leaves) == 1:
            return leaves[0]


def test_digests(spark, tmp_path):
    a = tmp_path / "one" / "art"
    os.makedirs(a / "sub")
    texts = {f"sub/p{i}": bytes([i]) * (i * 37) for i in range(1, 9)} | {"m": b"meta", "é f": b"x"}
    for n, t in texts.items():
        (a / n).write_bytes(t)
    (a / "big").write_bytes(os.urandom(5_000))
    texts["big"] = (a / "big").read_bytes()

    def of(t, piece, fan):
        return tree([sha(t[i:i + piece]) for i in range(0, max(1, len(t)), piece)], fan)

    got = {r["path"].split("/art/")[1]: (r["length"], r["sha256"]) for r in fl.file_digests(spark, str(a), piece=100, fan=3).collect()}
    assert got == {n: (len(t), of(t, 100, 3)) for n, t in texts.items()}
    one = fl.artifact_digest(spark, str(a), piece=100, fan=3)
    assert one == tree([f"{n}:{len(t)}:{of(t, 100, 3)}" for n, t in sorted(texts.items(), key=lambda x: x[0].encode())], 3)
    shutil.copytree(a, tmp_path / "elsewhere")
    assert fl.artifact_digest(spark, str(tmp_path / "elsewhere"), piece=100, fan=3) == one
    (tmp_path / "elsewhere" / "m").write_bytes(b"beta")
    assert fl.artifact_digest(spark, str(tmp_path / "elsewhere"), piece=100, fan=3) != one
    os.makedirs(tmp_path / "none")
    assert fl.artifact_digest(spark, str(tmp_path / "none")) is None


def test_a_file_above_two_gigabytes(spark, tmp_path):
    with open(tmp_path / "part", "wb") as f:  # sparse: it takes no disk
        f.truncate((2 << 30) + 5)
    got = fl.file_digests(spark, str(tmp_path), piece=512 << 20).first()
    h, whole = hashlib.sha256(), b"\0" * (1 << 20)
    for _ in range(512):
        h.update(whole)
    assert got["length"] == (2 << 30) + 5
    assert got["sha256"] == tree([h.hexdigest()] * 4 + [sha(b"\0" * 5)], 1024)
