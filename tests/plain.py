"""The semantics in plain Python, over small inputs, to hold the Spark jobs against."""

import math
import re


def is_consonant(word, i):
    return word[i] not in "aeiou" and (word[i] != "y" or i == 0 or not is_consonant(word, i - 1))


def measure(word):
    return sum(is_consonant(word, i) and not is_consonant(word, i - 1) for i in range(1, len(word)))


def has_vowel(word):
    return any(not is_consonant(word, i) for i in range(len(word)))


def ends_cvc(word):
    n = len(word)
    return n > 2 and [is_consonant(word, i) for i in (n - 3, n - 2, n - 1)] == [True, False, True] and word[-1] not in "wxy"


STEP2 = "ational ate tional tion enci ence anci ance izer ize bli ble alli al entli ent eli e ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble logi log".split()
STEP3 = ["icate", "ic", "ative", "", "alize", "al", "iciti", "ic", "ical", "ic", "ful", "", "ness", ""]
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def porter_stem(word):
    """Porter's algorithm by his paper, with ``bli`` and ``logi``."""
    if len(word) <= 2:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) else word
    else:
        for ending in ("ed", "ing"):
            rest = word.removesuffix(ending)
            if rest != word and has_vowel(rest):
                if rest[-2:] in ("at", "bl", "iz"):
                    rest += "e"
                elif len(rest) > 1 and rest[-1] == rest[-2] and rest[-1] not in "lsz" and is_consonant(rest, len(rest) - 1):
                    rest = rest[:-1]
                elif measure(rest) == 1 and ends_cvc(rest):
                    rest += "e"
                word = rest
                break
    if word.endswith("y") and has_vowel(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP2, STEP3):
        rules = dict(zip(table[::2], table[1::2]))
        ending = max((e for e in rules if word.endswith(e)), key=len, default=None)
        if ending and measure(word[: -len(ending)]):
            word = word[: -len(ending)] + rules[ending]
    ending = max((e for e in STEP4 if word.endswith(e)), key=len, default=None)
    if ending and measure(word[: -len(ending)]) > 1 and (ending != "ion" or word[-4:-3] in ("s", "t")):
        word = word[: -len(ending)]
    if word.endswith("e") and (measure(word[:-1]) > 1 or measure(word[:-1]) == 1 and not ends_cvc(word[:-1])):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and measure(word) > 1 else word


def tokens(text, options):
    found = [t for t in re.split(r"[^a-z0-9]+", (text or "").lower()) if t and t not in options.stopwords]
    return [porter_stem(t) for t in found] if options.stem else found


def again(terms, options):
    """A second analysis of analyzed text."""
    return tokens(" ".join(terms), options)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def alike(a, b, limit):
    if a is None or b is None or not max(len(a), len(b)):
        return False
    return edit_distance(a, b) / max(len(a), len(b)) < limit


def dph(tf, cf, length, average, n, ratio):
    if tf >= length:
        return 0.0
    f = tf / length
    rarity = n / cf if ratio == "real" else n // cf
    if not rarity:
        return float("-inf")
    norm = (1 - f) ** 2 / (tf + 1)
    return norm * (tf * math.log2(tf * average / length * rarity) + 0.5 * math.log2(2 * math.pi * tf * (1 - f)))


def rank(articles, queries, options):
    """``{query_id: [(doc_id, score, title), ...]}`` for articles (id, title, [(subtype, content), ...])."""
    docs = []
    for number, (doc_id, title, contents) in enumerate(articles):
        chosen = [c for c in contents or [] if c and (c[0] or "").lower() == "paragraph"][: options.max_paragraphs]
        head = tokens(title, options)
        body = [t for _, content in chosen for t in tokens(content, options)]
        counted = head + (again(body, options) if options.body_passes == 2 else body)
        if head or body:
            docs.append((doc_id, number, title, len(head) + len(body), counted))
    n = len(docs)
    average = sum(d[3] for d in docs) / n if n else 0
    result = {}
    for query_id, query in queries:
        terms = tokens(query, options)
        cf = {t: sum(d[4].count(t) for d in docs) for t in terms}
        rows = []
        for doc_id, number, title, length, counted in docs:
            hit = [t for t in terms if t in counted]
            if not hit and not options.include_unmatched:
                continue
            score = sum(dph(counted.count(t), cf[t], length, average, n, options.ratio) for t in hit)
            score = round(score / len(terms), options.score_digits) if hit else 0.0
            rows.append((-score, doc_id, number, title))
        kept = []
        for score, doc_id, _, title in sorted(rows, key=lambda r: r[:3]):
            if len(kept) == options.k:
                break
            if not any(alike(k[2], title, options.min_title_distance) for k in kept):
                kept.append((doc_id, -score + 0.0, title))
        if kept:
            result[query_id] = kept
    return result
