"""Plain versions of the operators, for small inputs."""

import hashlib
import re

BLANKS = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(BLANKS, text or "")


def shingles(text, n=5):
    found = words(lowered(text))
    if len(found) < n:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def near_duplicates(docs):
    """docs: (id, text) -> sorted [(id, n, component)]"""
    sets = [shingles(text) for _, text in docs]
    component = list(range(len(docs)))

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                component[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), None if d is None else smallest[root(i)]) for i, (d, _) in enumerate(docs)), key=repr
    )


def repeats(docs, size=50):
    """docs: (id, text) -> sorted [(id, words, removed, digest)]"""
    first = {}
    cut = [(doc_id, words(text)) for doc_id, text in docs]
    for doc_id, found in cut:
        for i in range(len(found) - size + 1) if doc_id is not None else ():
            key = tuple(found[i : i + size])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, found in cut:
        gone = [False] * len(found)
        for i in range(len(found) - size + 1) if doc_id is not None else ():
            if first[tuple(found[i : i + size])] < doc_id:
                gone[i : i + size] = [True] * size
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((doc_id, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


PATTERNS = (
    ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def secrets(text):
    """Sorted [(start, kind number, end)]"""
    out = []
    for kind, (_, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if len(m[2] if kind == 0 else m[0]) >= (6, 20, 24)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def targets(sizes):
    """sizes by source -> targets; the excess is shared again until none is above its limit"""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        level = left / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if level * weight[s] >= 2 * sizes[s]]
        if not over:
            return {**full, **{s: level * weight[s] for s in rest}}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def alignment(docs, tokenizers):
    """docs: (id, text) -> sorted rows as the operator's, token by token"""
    a_side, b_side, *_ = tokenizers
    symbol = {}
    shift = 0
    for byte in range(256):
        if 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or byte >= 0xAE:
            symbol[chr(byte)] = byte
        else:
            symbol[chr(0x100 + shift)] = byte
            shift += 1

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], {}
    for doc_id, text in docs:
        groups, pairs = [], []
        if text:
            raw = (" " + text).encode()
            a = [(i, bytes(symbol.get(c, 0x20) for c in a_side.whole.id_to_token(i))) for i in a_side.whole.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, b_bytes(i)) for i in b_side.encode(text)]
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                while a or b:
                    left, right = [a.pop(0)], [b.pop(0)]
                    size = len(left[0][1]) - len(right[0][1])
                    while size:
                        if size < 0:
                            left.append(a.pop(0))
                            size += len(left[-1][1])
                        else:
                            right.append(b.pop(0))
                            size -= len(right[-1][1])
                    groups.append(([i for i, _ in left], [i for i, _ in right]))
                pairs = [(x, y) for left, right in groups for x in left for y in right]
        for pair in set(pairs):
            counts[pair] = counts.get(pair, 0) + 1
        found.append((doc_id, groups, pairs))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, groups, pairs in found:
        joined = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        out.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(pairs),
            sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(joined.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def prefix_trie(turns):
    """turns: (conv_id, turn, role, text) without ties -> sorted rows as the operator's"""
    import zlib

    own = {}
    for conv, turn, role, text in sorted((t for t in turns if t[0] is not None), key=lambda t: (t[0], t[1] is not None, t[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        built[conv] = own.get(base, [])[:h] + own[conv][h:]
    members, ends = {}, {}
    for conv in sorted(built):
        for d in range(len(built[conv]) + 1):
            members.setdefault(tuple(built[conv][:d]), []).append(conv)
        ends.setdefault(tuple(built[conv]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        saved[node] = sum(saved[c] for c in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            (
                found[0], len(node), members[node[:-1]][0] if node else None, len(found), len(children.get(node, [])), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
            )
            for node, found in members.items()
        ),
        key=repr,
    )


def ppm(docs, order=4):
    """docs: (id, text) -> sorted [(id, held out, tokens, known, training tokens, base score, score)], scores unrounded"""
    import math
    import zlib

    def held_out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2

    def tokens(text):
        return [*words(lowered(text)), None]

    def symbols(text):
        return [*lowered(text).encode(), 255]

    unigram, tries = {}, {}
    for doc_id, text in docs:
        if held_out(doc_id):
            continue
        for token in tokens(text):
            unigram[token] = unigram.get(token, 0) + 1
        found = [255] * order + symbols(text)
        for i in range(order, len(found)):
            for k in range(order + 1):
                follow = tries.setdefault(tuple(found[i - k : i]), {})
                follow[found[i]] = follow.get(found[i], 0) + 1
    total = sum(unigram.values())

    def probability(context, symbol):
        gone, p = set(), 1.0
        for k in range(order, -1, -1):
            follow = tries.get(tuple(context[order - k :]))
            if follow is None:
                continue
            left = {s: n for s, n in follow.items() if s not in gone}
            if left:
                below = 2 * sum(left.values())
                if symbol in left:
                    return p * (2 * left[symbol] - 1) / below
                p *= len(left) / below
            gone = set(follow)
        return p / max(1, 256 - len(gone))

    out = []
    for doc_id, text in docs:
        found = [255] * order + symbols(text)
        score = sum(math.log10(probability(found[i - order : i], found[i])) for i in range(order, len(found)))
        base = sum(math.log10((unigram.get(t, 0) + 1) / (total + len(unigram) + 1)) for t in tokens(text))
        out.append((doc_id, held_out(doc_id), len(tokens(text)), sum(t in unigram for t in tokens(text)), total, base, score))
    return sorted(out, key=repr), probability
