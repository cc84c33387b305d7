"""Names as people type them: parsing persons and organisations, and whether two spellings may mean the same one."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Words that say nothing about who is meant.
TITLES = frozenset("mr mrs ms miss dr prof hon sir".split())
SUFFIXES = frozenset("jr sr ii iii iv md phd esq cpa cfa dds jd mba rn".split())
FILLERS = frozenset("the of for and com cl class ord shs adr ads new grp group ops common stock sponsored del".split())

# Short forms of first names.
NICKNAMES = {
    "alex": "alexander", "sandy": "alexander", "sasha": "alexander", "lex": "alexander", "andy": "andrew", "drew": "andrew", "tony": "anthony", "ben": "benjamin",
    "benny": "benjamin", "chas": "charles", "charlie": "charles", "chuck": "charles", "chris": "christopher", "topher": "christopher",
    "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "don": "donald", "ed": "edward", "eddie": "edward",
    "ned": "edward", "nell": "eleanor", "ellie": "eleanor", "nora": "eleanor", "liz": "elizabeth", "beth": "elizabeth", "betsy": "elizabeth",
    "betty": "elizabeth", "eliza": "elizabeth", "frank": "francis", "fred": "frederick", "geo": "george", "greg": "gregory", "hank": "henry",
    "harry": "henry", "jas": "james", "jim": "james", "jimmy": "james", "jen": "jennifer", "jenny": "jennifer", "jenn": "jennifer",
    "joe": "joseph", "jos": "joseph", "jon": "jonathan", "kate": "katherine", "kathy": "katherine",
    "katie": "katherine", "kat": "katherine", "ken": "kenneth", "larry": "lawrence", "maggie": "margaret", "meg": "margaret", "peggy": "margaret",
    "matt": "matthew", "mike": "michael", "mick": "michael", "nick": "nicholas", "pat": "patricia", "patty": "patricia", "trish": "patricia",
    "tricia": "patricia", "phil": "philip", "becky": "rebecca", "becca": "rebecca", "dick": "richard", "rich": "richard", "rick": "richard",
    "bob": "robert", "bobby": "robert", "rob": "robert", "robbie": "robert", "ron": "ronald", "sam": "samuel", "sammy": "samuel",
    "steve": "stephen", "steph": "stephen", "sue": "susan", "susie": "susan", "ted": "theodore", "jamie": "james", "hiro": "hiroshi", "theo": "theodore", "thos": "thomas",
    "tom": "thomas", "tommy": "thomas", "vicky": "victoria", "vicki": "victoria", "tori": "victoria", "bill": "william", "billy": "william",
    "will": "william", "wm": "william",
}

# Short forms that stand for a second name too.
ALSO = {"ted": "edward", "sandy": "sandra", "pat": "patrick", "chris": "christine", "sam": "samantha", "alex": "alexandra", "jon": "john", "nell": "helen", "kat": "katarina", "rich": "ricardo"}
INITIALS: dict[str, set[str]] = {}
for _short, _full in [*NICKNAMES.items(), *ALSO.items()]:
    INITIALS.setdefault(_full, {_full[0]}).add(_short[0])

# Words of trade and kind that many names share; a corpus adds its own (`variants.shared_words`).
KINDS = frozenset(
    """advisors aerospace agency airlines alliance analytics associates automotive bancorp bank beverages bioscience biosciences biotech board brands
    broadcasting building cancer capital center centre chemical chemicals children childrens clinic college communications construction consulting
    cooperative council data development diagnostics electric electronics energy engineering enterprises entertainment environmental equipment
    exchange federation financial foods forum foundation fund gas genomics government grain health healthcare holdings home hospital hotels
    industries infirmary infrastructure institute insurance international interactive investments labs laboratories leasing logistics machinery
    management manufacturing marine materials media medical medicine metals mining motors national network networks office oil oncology packaging
    partners petroleum pharmaceuticals plastics power products properties publishing realty regional renewables research reserve resources
    restaurants retail robotics royal school science sciences securities semiconductor services shipping society software solar solutions statistics
    steel stores systems technologies technology telecom textiles therapeutics transport transportation trust union university utilities ventures
    water workers""".split()
)
LEGAL = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "cp": "corp", "co": "co", "cos": "co", "company": "co", "ltd": "ltd",
    "limited": "ltd", "lp": "lp", "partnership": "lp", "llc": "llc", "plc": "plc", "sa": "sa", "nv": "nv", "ag": "ag", "se": "se", "gmbh": "gmbh",
}
SHORT_KINDS = {"pptys": "properties", "ppty": "properties", "svcs": "services", "svc": "services", "mgmt": "management", "natl": "national", "fdn": "foundation", "assn": "associates"}
CUT_LEGAL = ("incorporated", "limited", "partnership", "llc", "plc", "gmbh")
LONG_LEGAL = ("incorporated", "corporation", "company", "limited", "partnership")


def plain(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


@lru_cache(200_000)
def edits(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, changes and swaps of neighbours between a and b; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row, older = row, [i], before
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before = last
    return min(row[-1], most + 1)


def grams(text: str, sizes: tuple[int, ...] = (3,)) -> list[str]:
    """Distinct character n-grams of each word, with its ends marked."""
    out = {}
    for word in text.split():
        word = f"#{word}#"
        for n in sizes:
            out.update(dict.fromkeys(word[i : i + n] for i in range(max(1, len(word) - n + 1))))
    return list(out)


# Persons


@lru_cache(100_000)
def person_words(name: str) -> tuple[str, ...]:
    """The words of a person's name, without titles and suffixes, in their order, the family name last if a comma tells it."""
    family = []
    text = plain(name).replace(".", " " if re.search(r"\.\w{2,}", name) and not re.search(r"(?i)ph\.d|m\.d", name) else "")
    if "," in text:
        head, _, tail = text.partition(",")
        rest = [w for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", tail) if w not in TITLES and w not in SUFFIXES]
        if rest:
            family, text = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", head), " ".join(rest)
    words = [*re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text), *family]
    kept = [w for w in words if w not in TITLES and w not in SUFFIXES]
    return tuple(kept or words)


def _formal(first: str) -> set[str]:
    """The names that a first name may be a short form of, and itself."""
    return {first, NICKNAMES.get(first, first), ALSO.get(first, first)}


def _initials(first: str) -> set[str]:
    return {first[0]} if len(first) == 1 else set().union(*(INITIALS.get(f, {f[0]}) for f in _formal(first)))


@lru_cache(100_000)
def _first_names(a: str, b: str) -> float:
    """2 for the same first name, 1 for a fitting initial, 0 if they differ."""
    if len(a) == 1 or len(b) == 1:
        return 1.0 if _initials(a) & _initials(b) else 0.0
    if _formal(a) & _formal(b):
        return 2.0
    shortest = min(len(a), len(b))
    if shortest >= 3 and (a.startswith(b) or b.startswith(a)):
        return 2.0
    if shortest >= 4 and edits(a, b, 2) <= (1 if shortest < 7 else 2):
        return 2.0
    for x, y in ((a, b), (b, a)):
        if len(x) >= 4 and any(len(f) >= 4 and edits(x, f, 1) <= 1 for f in _formal(y)):
            return 2.0
    near = lambda w: {f for n, f in [*NICKNAMES.items(), *ALSO.items()] if len(n) >= 4 and len(w) >= 4 and edits(w, n, 1) <= 1}
    return 2.0 if _formal(b) & near(a) or _formal(a) & near(b) else 0.0


@lru_cache(200_000)
def same_person(a: str, b: str) -> float:
    """How sure two spellings within one company mean one person: 0 to 1, under 0.7 where one of them tells too little.

    For each choice of family names that are at most two typing errors apart, first names must be equal, short for each
    other, or fit as initials, and middle names must not contradict."""
    wa, wb = person_words(a), person_words(b)
    best = 0.0
    for i, x in enumerate(wa):
        for j, y in enumerate(wb):
            shortest = min(len(x), len(y))
            if shortest < 3:
                continue
            d = edits(x, y, 2)
            if d > (2 if shortest >= 6 else 1):
                continue
            ra, rb = wa[:i] + wa[i + 1 :], wb[:j] + wb[j + 1 :]
            if not ra or not rb:
                best = max(best, 0.6) if ra == rb and d == 0 else best
                continue
            first = _first_names(ra[0], rb[0])
            if not first:
                continue
            middle = 0.0
            if len(ra) > 1 and len(rb) > 1:
                if ra[1][0] != rb[1][0]:
                    continue
                middle = 1.0
            if d == 1 and first < 2 and not middle or d == 2 and first < 2 and not middle:
                continue
            if first < 2 and not middle:
                best = max(best, 0.65)
            else:
                best = max(best, 0.7 + 0.1 * (first == 2) + 0.1 * middle + 0.1 * (d == 0))
    return best


# Organisations


class Trade:
    """Words of trade, and the parsing of organisations by them."""

    def __init__(self, words: tuple[str, ...] = ()):
        """`words`: what a corpus shares beyond KINDS, most frequent first; those that already stand for a known one add nothing."""
        self.kinds = set(KINDS)
        self._index()
        for w in words:
            if w not in FILLERS and w not in LEGAL and not self._kinds_of(w)[0]:
                self.kinds.add(w)
                self._index()
        self.kinds_of = lru_cache(200_000)(self._kinds_of)
        self.organisation = lru_cache(200_000)(self._organisation)
        self.same = lru_cache(200_000)(self._same)

    def _index(self) -> None:
        self.deleted: dict[str, set[str]] = {}
        self.long: dict[str, list[str]] = {}
        for k in sorted(self.kinds):
            for i in range(len(k)):
                self.deleted.setdefault(k[:i] + k[i + 1 :], set()).add(k)
            if len(k) >= 9:
                self.long.setdefault(k[0], []).append(k)
        self.by_length = sorted(self.kinds, key=lambda k: (-len(k), k))

    def _kinds_of(self, word: str) -> tuple[frozenset[str], str]:
        """Words of trade that `word` may stand for, and what is left of it as a name of its own."""
        if word in self.kinds or word in SHORT_KINDS:
            return frozenset([self._one(SHORT_KINDS.get(word, word))]), ""
        if len(word) >= 3:
            short = {k for k in self.kinds if k[0] == word[0] and len(word) < len(k) and _inside(word, k)}
            if short:
                starts = {k for k in short if k.startswith(word)}
                return frozenset(map(self._one, starts or short)), ""
        if len(word) >= 5:
            near = {k for k in self._one_edit(word) if edits(word, k, 1) <= 1} | {k for k in self.long.get(word[0], ()) if edits(word, k, 2) <= 2}
            if near:
                return frozenset(map(self._one, near)), ""
            for k in self.by_length:
                if len(k) >= 4 and len(word) - len(k) >= 4:
                    if word.endswith(k):
                        return frozenset([self._one(k)]), word[: -len(k)]
                    if word.startswith(k) and len(k) >= 6:
                        return frozenset([self._one(k)]), word[len(k) :]
        return frozenset(), word

    def _one(self, kind: str) -> str:
        """The singular where both are listed."""
        kind = {"centre": "center", "laboratories": "labs", "technology": "technologies"}.get(kind, kind)
        return kind[:-1] if kind.endswith("s") and kind[:-1] in self.kinds else kind

    def _one_edit(self, word: str) -> set[str]:
        """Kinds that may be one edit away: those that share the word, or what a deletion leaves of either."""
        found = set(self.deleted.get(word, ()))
        for i in range(len(word)):
            rest = word[:i] + word[i + 1 :]
            found |= self.deleted.get(rest, set())
            if rest in self.kinds:
                found.add(rest)
        return found

    def _organisation(self, name: str) -> tuple[tuple[str, ...], tuple[frozenset[str], ...], str]:
        text = re.sub(r"[/\\][A-Za-z]{2,4}[/\\]?(?=\s|$)", " ", name)
        text = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", text)
        text = re.sub(r"[.’']", "", plain(text))
        words = re.findall(r"[^\W_]+", text)
        own, kinds, legal = [], [], ""
        for i, w in enumerate(words):
            if len(w) == 1 and len(words) > 1 or w in FILLERS:
                continue
            form = _legal(w, i == len(words) - 1) if i or len(words) == 1 else _legal(w) if len(w) > 3 else None
            if form:
                legal = "lp" if {form, legal} == {"ltd", "lp"} else legal or form
                continue
            meant, rest = self.kinds_of(w)
            if meant:
                kinds.append(meant)
            if rest:
                own.append(rest)
        if not own:
            own = [w for w in words if w not in FILLERS and len(w) > 1] or words
            kinds = []
        return tuple(sorted(own)), tuple(kinds), legal

    def _same(self, a: str, b: str) -> float:
        (own_a, kinds_a, legal_a), (own_b, kinds_b, legal_b) = self.organisation(a), self.organisation(b)
        if not own_a or not own_b:  # of signs alone
            return float(a == b)
        if len(own_a) != len(own_b):
            return 0.0
        total, left = 0, list(own_b)
        for x in own_a:
            d, hit = min(((edits(x, y, 2), y) for y in left), default=(3, ""))
            if d > (2 if min(len(x), len(hit)) >= 8 else 1 if min(len(x), len(hit)) >= 4 else 0):
                return 0.0
            total += d
            left.remove(hit)
        clash = bool(legal_a and legal_b and legal_a != legal_b)
        if bool(kinds_a) != bool(kinds_b):
            return 0.0 if clash or total > 1 else 0.65 if legal_a and legal_a == legal_b else 0.6 if not total else 0.0
        if not kinds_fit(kinds_a, kinds_b) or (clash and not kinds_a):
            return 0.0
        return 1.0 - 0.08 * min(total, 3) - 0.15 * clash


@lru_cache(8)
def trade(words: tuple[str, ...] = ()) -> Trade:
    """Kept by process, as only the words are sent to it."""
    return Trade(words)


def _inside(short: str, word: str) -> bool:
    letters = iter(word)
    return all(c in letters for c in short)


def _legal(word: str, last: bool = False) -> str | None:
    """The legal form that a word stands for; a last word of two letters or more may be cut off."""
    if word in LEGAL:
        return LEGAL[word]
    if last and len(word) >= 2:
        full = next((f for f in CUT_LEGAL if f.startswith(word)), None)
        if full:
            return LEGAL[full]
    if len(word) >= 4:
        for full in LONG_LEGAL:
            if full.startswith(word) or (len(word) >= 6 and edits(word, full, 1) <= 1):
                return LEGAL[full]
    return None


def organisation(name: str) -> tuple[tuple[str, ...], tuple[frozenset[str], ...], str]:
    """(own words in alphabetic order, words of trade as sets of what each may mean, legal form or '')."""
    return trade().organisation(name)


def kinds_fit(a: tuple[frozenset[str], ...], b: tuple[frozenset[str], ...]) -> bool:
    """Whether the words of trade can be paired off."""
    if len(a) != len(b):
        return False
    left = list(b)
    for x in sorted(a, key=len):
        hit = next((y for y in sorted(left, key=len) if x & y), None)
        if hit is None:
            return False
        left.remove(hit)
    return True


def same_organisation(a: str, b: str) -> float:
    """How sure two spellings mean one organisation: 0 to 1. 0.6 where only one of them tells its trade."""
    return trade().same(a, b)
