"""Plain versions of the operators, over lists of rows."""

import hashlib
import re
import zlib

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def token_counts(docs):
    out = []
    for doc_id, text in docs:
        n = len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 512))
    return out


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(
        1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)
    )


def simhash(docs):
    marked = [(doc_id, fingerprint(text)) for doc_id, text in docs]
    distinct = sorted({f for _, f in marked})
    group = {f: f for f in distinct}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                group[root(a)] = root(b)
    least = {}
    for doc_id, f in marked:
        if doc_id is not None:
            least[root(f)] = min(doc_id, least.get(root(f), doc_id))
    return [(doc_id, f"{f:016x}", least.get(root(f))) for doc_id, f in marked]


def luhn(digits):
    twice = [2 * int(d) if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontaminate(docs, benchmark):
    windows = {}
    for item, text in benchmark:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    items |= found
        ids = sorted(str(i) for i in items if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), sha256(",".join(ids)), bool(hit)))
    return out


def pieces(docs):
    out = []
    for doc_id, text in docs:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            raw = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            out.append((doc_id, k, a, b - a, zlib.crc32(raw)))
    return out


def edited_texts(docs):
    """doc_id, edited text and the next text, of (doc_id, text) in ascending order."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text[: len(text) - half] + after[:half], after))
    return out


def text_hash(raw):
    h = xxhash.xxh64_intdigest(raw, seed=42)
    return h - (1 << 64) if h >> 63 else h


def hash_longs(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def letters(text):
    return [x for x in re.split("(?<=[^b-ik-pr-wy])", text or "") if x]


def anchors(text, k=5, s=2):
    """(place, hash) of the chosen k-mers of a text's letters, or of its whole."""
    h, wide = [text_hash(x.encode()) for x in letters(text)], k - s
    m = [hash_longs(h[i : i + s]) for i in range(len(h) - s + 1)]
    out = [
        (i, hash_longs([m[i], m[i + 2], m[i + 3]]))
        for i in range(len(h) - k + 1)
        if min(m[i], m[i + wide]) <= min(m[i + 1 : i + wide])
    ]
    return out or ([(0, hash_longs(h))] if h else [])


def sketch(hashes, size=32):
    ordered = sorted(hashes)
    out = "".join(f"{h & (1 << 64) - 1:016x}" for h in ordered[:size])
    if len(ordered) > size:
        out += f"{hash_longs(ordered) & (1 << 64) - 1:016x}"
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def in_place(a, b, k=5):
    """Passages of two texts' anchors at the same places."""
    out = []
    for at in sorted(p for p, _ in set(a) & set(b)):
        if out and at - (out[-1][1] - k) <= k:
            out[-1][1] = at + k
        else:
            out.append([at, at + k])
    return ",".join(f"{x}:{y}" for x, y in out)


def syncmers(docs):
    """Rows of op5 for (doc_id, text) in their order."""
    out = []
    for (doc_id, text), (_, edited, after) in zip(docs, edited_texts(docs)):
        a, b = anchors(text), anchors(edited)
        own, changed, follow = ({h for _, h in x} for x in (a, b, anchors(after)))
        out.append((
            doc_id, len(text or ""), sha256(edited), sketch(own), sketch(changed),
            round(jaccard(own, changed), 9), round(jaccard(own, follow), 9), in_place(a, b),
        ))
    return out
