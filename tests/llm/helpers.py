"""Rows with every awkward case, and plain-Python versions of the rules."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 8000

#: doc_id, text, source and columns whose names operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, size int, slot string, shard int, score string, bits int, "
          "`__text` string, `__key` string, spans int, comp int, `odd name` int, `__pii_all` int, `__mix_bits` int")
EDGE_TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the small red hen"), (2, None), (3, ""), (4, "   "),
    (5, "word"), (6, LONG), (7, "the quick brown fox jumps over the lazy dog and runs away from the small red hen"),
    (7, "the quick brown fox jumps over the lazy dog and runs away from the small red hen"), (None, "a text without an id, mail me at x@y.org"),
    (None, None), (8, "é漢字😀 \u00a0 ünï"), (9, "\x00\x01 \t\r\n"), (10, "a b c d e"), (10, "a b c d f"),
]


def edge_docs(spark):
    rows = [(i, t, None if k % 3 == 0 else "xx", None if k % 4 == 0 else f"src{k % 3}", k, "s", k, "x", k, "y", "z", 1, 2, 3, 4, 5)
            for k, (i, t) in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(table: str, sf: str = SF) -> list[dict]:
    return pq.read_table(f"{sf}/{table}.parquet").to_pylist()


def word_list(text) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingle_counts(text) -> Counter:
    w = word_list(text)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def least_edits(item: list[str], words: list[str]) -> int:
    """Least word edits from ``item`` to any run of ``words``."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def repeats(texts: list, length: int) -> list[tuple]:
    bodies, seen = [(t or "").encode() for t in texts], Counter()
    for b in bodies:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def base_pii(text) -> list[tuple]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def judge(url: str | None, rules) -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
    best = None
    for verdict, rule in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return (host, path, *(best or (None, "allow")))


def mix(rows: list[tuple]) -> dict[int, tuple]:
    """(doc_id, text, source) with unique ids -> doc_id: (size, source_size, target, taken)."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    total: Counter = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(total.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= over

    def bits(i, t, x):
        draw = "\x1f".join(["mix", f"v{i}", "n" if x is None else f"v{x}", hashlib.md5((t or "").encode()).hexdigest()])
        return int(hashlib.md5(f"{hashlib.md5(draw.encode()).hexdigest()}:0".encode()).hexdigest()[:13], 16)

    out = {}
    for s in order:
        own = [(i, bits(i, t, x)) for i, t, x in rows if x == s]
        certain = int(target[s] // total[s]) if total[s] else 0
        quota = target[s] - certain * total[s]
        chance = mix_chances({i: size[i] for i, _ in own}, quota)
        sure = {i for i, p in chance.items() if p >= 1}
        quotient = {i: (u := (b + 0.5) / 2**52) / (1 - u) / (chance[i] / (1 - chance[i])) for i, b in own if 0 < chance[i] < 1}
        seen = sum(size[i] for i in sure)
        for i in sorted(quotient, key=quotient.get):
            if seen + size[i] / 2 <= quota:
                sure.add(i)
            seen += size[i]
        for i, _ in own:
            out[i] = (size[i], total[s], target[s], size[i] * (certain + (i in sure)))
    return out


def mix_chances(size: dict, quota: float) -> dict:
    """Inclusion probabilities min(1, c * class) whose expected words are the quota, by bisection."""
    classes = {i: max(1, n >> max(0, n.bit_length() - 4) << max(0, n.bit_length() - 4)) for i, n in size.items()}
    if quota <= 0 or not sum(size.values()):
        return dict.fromkeys(size, 0.0)
    lo, hi = 0.0, 1.0
    for _ in range(200):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if sum(min(1, c * classes[i]) * n for i, n in size.items()) < quota else (lo, c)
    return {i: 1.0 if c * k > 1 - 1e-12 else c * k for i, k in classes.items()}
