"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def token_store(docs, end_id=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        rows.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return rows


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    spans = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append((kind, m.start(), m.end()))
    return spans


def pii(docs):
    rows = []
    for doc_id, text in docs:
        spans = base_spans(text)
        kinds = Counter(s[0] for s in spans)
        rows.append((doc_id, *[kinds[k] for k in BASE], sha(",".join("%s:%d:%d" % s for s in spans))))
    return rows


def lower_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = lower_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            if size:
                windows[tuple(words[i : i + size])].add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc_id, text in docs:
        words = lower_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[w] - {None}
        digest = sha(",".join(sorted(map(str, found))))
        rows.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return rows


def piece_digests(docs):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = []
    for doc_id, text in docs:
        ids = model.encode(text or "")
        rows.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))))
    return rows


def rule_counts(docs):
    rows = []
    for doc_id, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, doubled = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                doubled += line in seen
                seen.add(line)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i : i + 8])] > 1:
                repeated.update(range(i, i + 8))
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        rows.append((doc_id, len(words), sum(map(len, words)), symbols, doubled, len(repeated), failed))
    return rows


def removal(docs, length=400):
    places = Counter()
    texts = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    for _, data in texts:
        places.update(data[i : i + length] for i in range(len(data) - length + 1))
    rows = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if places[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        rows.append((doc_id, len(data), sum(gone), spans, sha(kept)))
    return rows


def labelled_shingles(text, size=5):
    words = lower_words(text)
    size = min(size, len(words))
    seen, out = Counter(), []
    for i in range(len(words) - size + 1 if words else 0):
        shingle = tuple(words[i : i + size])
        out.append((shingle, seen[shingle]))
        seen[shingle] += 1
    return out


def aligned(a, b):
    """Length of the longest common subsequence of two lists of different labels."""
    place = {x: i for i, x in enumerate(b)}
    best = []
    for p in (place[x] for x in a if x in place):
        from bisect import bisect_left

        k = bisect_left(best, p)
        best[k : k + 1] = [p]
    return len(best)


def classes(docs, least=0.8):
    """Component of each row, by comparing all pairs."""
    shingles = [labelled_shingles(t) for _, t in docs]
    sets = [set(s) for s in shingles]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if not shingles[i] or not shingles[j]:
                same = not shingles[i] and not shingles[j] and (docs[i][1] or "") == (docs[j][1] or "")
            else:
                both = len(sets[i] & sets[j])
                same = both >= least * (len(sets[i]) + len(sets[j]) - both)
                if same:
                    n = aligned(shingles[i], shingles[j])
                    same = n >= least * (len(shingles[i]) + len(shingles[j]) - n)
            if same:
                parent[find(i)] = find(j)
    least_id = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            root = find(i)
            least_id[root] = min(least_id.get(root, doc_id), doc_id)
    return [(doc_id, least_id.get(find(i))) for i, (doc_id, _) in enumerate(docs)]


def byte_level():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_alignment(docs):
    """Each text as a whole through both libraries, all pairs of tokens compared by their byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    to_byte = byte_level()

    def spans(parts):
        at, found = 0, []
        for i, piece in parts:
            found.append((i, at, at + len(piece)))
            at += len(piece)
        return found

    def piece_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    cut, counts = [], Counter()
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids
        parts_a = [(i, bytes(to_byte[c] for c in a.id_to_token(i))) for i in ids]
        parts_b = [(i, piece_bytes(i)) for i in b.encode(text or "")]
        told = bool(text) and all(b"".join(p for _, p in parts) == whole for parts in (parts_a, parts_b))
        sa, sb = (spans(parts_a), spans(parts_b)) if told else ([], [])
        links, j0 = [], 0
        for i, s, e in sa:
            while j0 < len(sb) and sb[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][1] < e:
                links.append((i, sb[j][0]))
                j += 1
        counts.update(links)
        ends = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups, at = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if at <= s and e <= end) for side in (sa, sb)]
            groups.append("|".join(sides))
            at = end
        cut.append((doc_id, len(sa), len(sb), len(groups), links, sha(";".join(groups)) if told else ""))
    best = defaultdict(int)
    for (_, i), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (d, na, nb, ng, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), text)
        for d, na, nb, ng, links, text in cut
    ]


def simhash(docs):
    """Fingerprints bit by bit, all pairs compared."""
    from xxhash import xxh64_intdigest

    prints = []
    for _, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    least = components(prints)
    ids = defaultdict(list)
    for (doc_id, _), f in zip(docs, prints):
        if doc_id is not None:
            ids[least[f]].append(doc_id)
    return [(d, f"{f:016x}", min(ids[least[f]], default=None)) for (d, _), f in zip(docs, prints)]


def components(prints, distance=2):
    """For each fingerprint the least that links reach."""
    different = sorted(set(prints))
    parent = {f: f for f in different}

    def find(f):
        while parent[f] != f:
            parent[f] = parent[parent[f]]
            f = parent[f]
        return f

    for i, f in enumerate(different):
        for g in different[i + 1 :]:
            if (f ^ g).bit_count() <= distance:
                x, y = find(f), find(g)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in different}


def hard_negatives(rows, anchor_every=100, n_positives=5, n_negatives=10):
    import math

    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.append((vec_id, label, [math.floor(256 * float(x)) for x in vector]))
    found = []
    for anchor, own, v in usable:
        if anchor % anchor_every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), other, label) for other, label, w in usable if other != anchor
        )
        for score, positive, _ in [s for s in scored if s[2] == own][:n_positives]:
            window = [s for s in scored if s[2] != own and 30 * -score <= 100 * -s[0] <= 90 * -score]
            found += [(anchor, positive, i, n, -score, -s) for i, (s, n, _) in enumerate(window[:n_negatives], 1)]
    return found


def thue_morse(n, a="a", b="b"):
    """A word of regular shape: sums of letters times powers of an odd base are equal for it and its opposite."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))
