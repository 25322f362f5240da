"""Names of firms and persons as people type them: their parts, and whether two spellings can be the same name."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from tidemark.llm.lookalike import consistent

#: Legal forms, titles and connecting words, which do not tell names apart.
FORMS = frozenset(
    """llp llc lllp lp pc pllc pa plc inc corp ltd limited co company cpa cpas ca cas chartered sc
    certified public acc accountant accountants accounting auditors partners partnership associates group firm
    messrs mr mrs ms dr and the of us usa uk intl international formerly fka pcaob id""".split()
)
#: Words of fillers that name nobody.
FILLERS = frozenset(
    """none null nil na tbd tba unknown unnamed undisclosed not no disclosed named known available applicable given stated
    our the former prior previous current new old predecessor successor auditor auditors accountant accountants firm
    see exhibit exh item note form attached pending to be determined various other same as above below n a""".split()
)
#: Short forms of given names.
SHORT_NAMES = {
    "abby": "abigail", "al": "albert", "alex": "alexander alexandra", "andy": "andrew", "angie": "angela", "art": "arthur", "barb": "barbara", "becky": "rebecca",
    "ben": "benjamin", "bernie": "bernard", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert",
    "brad": "bradley", "cathy": "catherine", "charlie": "charles", "chris": "christopher christine christina", "chuck": "charles", "cindy": "cynthia", "dan": "daniel",
    "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "don": "donald", "dot": "dorothy", "doug": "douglas", "drew": "andrew", "ed": "edward edwin",
    "eddie": "edward", "fran": "frances", "frank": "francis", "fred": "frederick", "gene": "eugene", "gerry": "gerald", "greg": "gregory", "hank": "henry", "harry": "harold henry",
    "jack": "john", "jackie": "jacqueline", "jake": "jacob", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald jerome", "jim": "james", "jimmy": "james", "joe": "joseph",
    "jon": "jonathan", "josh": "joshua", "judy": "judith", "kate": "katherine", "kathy": "katherine kathleen", "katie": "katherine", "ken": "kenneth", "kim": "kimberly", "larry": "lawrence",
    "len": "leonard", "liz": "elizabeth", "lou": "louis", "maggie": "margaret", "marge": "margaret", "matt": "matthew", "meg": "margaret", "mel": "melvin", "mike": "michael", "mickey": "michael",
    "nan": "nancy", "nat": "nathaniel", "nate": "nathan", "ned": "edward", "nick": "nicholas", "pam": "pamela", "pat": "patricia patrick", "patty": "patricia", "peg": "margaret", "peggy": "margaret",
    "pete": "peter", "phil": "philip", "ray": "raymond", "rich": "richard", "rick": "richard", "rob": "robert", "ron": "ronald", "sally": "sarah", "sam": "samuel samantha", "sandy": "sandra",
    "sasha": "alexandra alexander", "steve": "steven stephen", "stu": "stuart", "sue": "susan", "susie": "susan", "ted": "theodore edward", "terry": "terence theresa", "theo": "theodore", "tim": "timothy",
    "tom": "thomas", "tony": "anthony", "trish": "patricia", "val": "valerie", "vicky": "victoria", "vicki": "victoria", "vince": "vincent", "walt": "walter", "will": "william", "zach": "zachary",
}

_dotted = re.compile(r"\b(?:[a-z]\.){2,}")
_former = re.compile(r"\(\s*(?:formerly|f/k/a|fka)\s+([^)]*)\)")
_aside = re.compile(r"\([^)]*\)")


#: Legal forms that are written with dots.
_LEGAL = frozenset("llp lllp llc lp pllc pc pa sc cpa ca usa us".split())


def _undot(match: re.Match) -> str:
    """A dotted run is a legal form where it is one and does not open the name; otherwise it is initials."""
    letters = match.group().replace(".", "")
    return f" {letters} " if match.start() > 0 and letters in _LEGAL else " " + " ".join(letters) + " "


@lru_cache(maxsize=50_000)
def parts(name: str) -> tuple[tuple[str, ...], str, tuple[str, ...]]:
    """(tokens, acronym, former): the telling words in order, a bare or leading acronym, and the words of a former name.

    ``former`` is filled where the name is written "ABC (formerly ...)"; tokens are then those of the former name.
    """
    text = consistent(name)[0]
    former = _former.search(text)
    text = _aside.sub(" ", text)
    text = _dotted.sub(_undot, text)
    words = [w for w in re.sub(r"[^\w]+|_", " ", text.replace("'", "")).split() if not w.isdigit()]
    tokens = [w for w in words if w not in FORMS]
    if len(tokens) > 2 and all(len(t) == 1 for t in tokens):
        tokens = ["".join(tokens)]
    acronym = tokens[0] if len(tokens) == 1 and 2 <= len(tokens[0]) <= 4 else ""
    if former:
        old = tuple(w for w in re.sub(r"[^\w]+", " ", former.group(1)).split() if w not in FORMS)
        return (old, acronym, old) if acronym else (tuple(tokens), "", old)
    return tuple(tokens), acronym, ()


def is_filler(name: str) -> bool:
    """Names nobody: no telling word, or only words of fillers."""
    words = re.sub(r"[^\w]+", " ", consistent(name)[0]).split()
    return not any(w not in FILLERS and w not in FORMS and not w.replace(".", "").isdigit() for w in words)


def one_edit(a: str, b: str) -> bool:
    """Equal, or one character changed, missing, added, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def same_token(a: str, b: str) -> bool:
    if a == b:
        return True
    full_a, full_b = {a, *SHORT_NAMES.get(a, "").split()}, {b, *SHORT_NAMES.get(b, "").split()}
    if full_a & full_b:
        return True
    return min(len(a), len(b)) >= 4 and one_edit(a, b)


def letters_of(token: str) -> set[str]:
    return {token[0], *(f[0] for f in SHORT_NAMES.get(token, "").split())}


@dataclass
class Pairing:
    """How two names' words pair: ``paired`` words with words, ``by_letter`` (word, whether it is b's) with an initial; the rest of either side."""

    paired: int
    by_letter: list[tuple[str, bool]]
    missed: int
    loose_a: list[str]
    loose_b: list[str]


def pairing(a: tuple[str, ...], b: tuple[str, ...]) -> Pairing | None:
    """Words pair when equal, one edit apart or short forms of each other; an initial pairs with a word it begins."""
    long_a, long_b = [t for t in a if len(t) > 1], [t for t in b if len(t) > 1]
    if not long_a or not long_b:
        return None
    rest_b, rest_a, paired = list(long_b), [], 0
    for t in sorted(long_a, key=lambda t: t not in long_b):
        hit = t if t in rest_b else next((u for u in rest_b if same_token(t, u)), None)
        if hit is None:
            rest_a.append(t)
        else:
            rest_b.remove(hit)
            paired += 1
    loose_a, loose_b = [t for t in a if len(t) == 1], [t for t in b if len(t) == 1]
    by_letter = []
    for words, letters, of_b in ((rest_a, loose_b, False), (rest_b, loose_a, True)):
        for w in list(words):
            hit = next((x for x in letters if x in letters_of(w)), None)
            if hit is not None:
                letters.remove(hit)
                words.remove(w)
                by_letter.append((w, of_b))
    for x in list(loose_a):
        if x in loose_b:
            loose_a.remove(x)
            loose_b.remove(x)
    return Pairing(paired, by_letter, len(rest_a) + len(rest_b), loose_a, loose_b)


def similarity(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Share of the two token sets that can be paired one to one; 0 where an initial contradicts.

    A middle initial that only one side has is passed over, a leading one is not.
    """
    p = pairing(a, b)
    if p is None:
        return 1.0 if a == b else 0.0
    if not p.paired or (p.loose_a and p.loose_b):
        return 0.0
    lead = (p.loose_a and a[0] == p.loose_a[0]) or (p.loose_b and b[0] == p.loose_b[0])
    whole = 2 * (p.paired + len(p.by_letter))
    return whole / (whole + p.missed + bool(lead))


def adds(a: tuple[str, ...], b: tuple[str, ...]) -> str:
    """What b tells that a leaves open: its middle initial, and the word that a only begins; empty where nothing."""
    p = pairing(a, b)
    if p is None:
        return ""
    return " ".join(sorted([f"i:{x}" for x in p.loose_b] + [f"w:{w}" for w, of_b in p.by_letter if of_b]))


def contradict(told: list[str]) -> bool:
    """Whether what several names add to one can't all be true of it."""
    kinds: dict[str, list[str]] = {"i": [], "w": []}
    for t in told:
        for part in t.split():
            kinds[part[0]].append(part[2:])
    return len(set(kinds["i"])) > 1 or any(not same_token(x, y) for x in kinds["w"] for y in kinds["w"] if x < y)


def same_name(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Every word of either name finds its partner, and at least two do (or the one word is the same and long)."""
    if len(a) == 1 or len(b) == 1:
        run_a, run_b = "".join(a), "".join(b)
        return run_a == run_b and len(run_a) >= 3
    return similarity(a, b) == 1.0


def cut_variants(token: str) -> list[str]:
    """The token and every form with one character left out: two tokens one edit apart share one of these."""
    return [token, *{token[:i] + token[i + 1 :] for i in range(len(token))}]


def _heads(token: str) -> list[str]:
    """The token, and less its first or second character: two tokens one edit apart that begin differently share one of these."""
    return [token, token[1:], token[:1] + token[2:]] if len(token) >= 4 else [token]


def block_keys(tokens: tuple[str, ...]) -> set[str]:
    """Keys of which two names that ``same_name`` accepts share one: a word less a character, or the given name it is short for,
    beside another word's first letter; where slips change the first letters of both words, the two words less a letter at the front.
    """
    keys = {"run " + "".join(tokens)}
    for i, t in enumerate(tokens):
        if len(t) < 2:
            continue
        variants = {*(cut_variants(t) if len(t) >= 4 else [t]), *SHORT_NAMES.get(t, "").split()}
        for j, u in enumerate(tokens):
            if i != j:
                keys.update(f"{v} {x}" for v in variants for x in letters_of(u))
            if i < j and len(t) >= 4 and len(u) >= 4:
                keys.update("both " + " ".join(sorted((v, w))) for v in _heads(t) for w in _heads(u))
    return keys


def _whole_keys(token: str) -> set[str]:
    """Keys of which two words that ``same_token`` accepts share one."""
    return {*(cut_variants(token) if len(token) >= 4 else [token]), *SHORT_NAMES.get(token, "").split()}


def finer_keys(tokens: tuple[str, ...], key: str) -> set[str]:
    """Finer keys of a name in the block ``key``, the second word whole; empty where the name meets the whole block.

    Two matching names whose words make the key share a finer key, unless one of them has a letter for the second word.
    Blocks of a run or of two words are kept as they are.
    """
    first, _, letter = key.rpartition(" ")
    if first == "run" or first.startswith("both ") or len(letter) != 1:
        return {key}
    out: set[str] = set()
    for i, t in enumerate(tokens):
        if len(t) < 2 or first not in _whole_keys(t):
            continue
        for j, u in enumerate(tokens):
            if i != j and letter in letters_of(u):
                if len(u) == 1:
                    return set()
                out.update(f"{first} {letter} {w}" for w in _whole_keys(u))
    return out
