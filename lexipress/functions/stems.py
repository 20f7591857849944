"""Word stems of Russian and English by ordered suffix rules.

The rules are those of the public Snowball descriptions of both languages.  A stem is made
once for each different word of a batch (see ``fulltext``), never once an occurrence.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Endings of Russian, by the class of Snowball's description they belong to.
# The endings of the first tuple of a pair only count after а or я, which stay.
GERUND = (("в", "вши", "вшись"), ("ив", "ивши", "ившись", "ыв", "ывши", "ывшись"))
ADJECTIVE = ("ее", "ие", "ые", "ое", "ими", "ыми", "ей", "ий", "ый", "ой", "ем", "им", "ым", "ом", "его", "ого", "ему", "ому", "их", "ых", "ую", "юю", "ая", "яя", "ою", "ею")
PARTICIPLE = (("ем", "нн", "вш", "ющ", "щ"), ("ивш", "ывш", "ующ"))
REFLEXIVE = ("ся", "сь")
VERB = (
    ("ла", "на", "ете", "йте", "ли", "й", "л", "ем", "н", "ло", "но", "ет", "ют", "ны", "ть", "ешь", "нно"),
    ("ила", "ыла", "ена", "ейте", "уйте", "ите", "или", "ыли", "ей", "уй", "ил", "ыл", "им", "ым", "ен", "ило", "ыло", "ено", "ят", "ует", "уют", "ит", "ыт", "ены", "ить", "ыть", "ишь", "ую", "ю"),
)
NOUN = ("а", "ев", "ов", "ие", "ье", "е", "иями", "ями", "ами", "еи", "ии", "и", "ией", "ей", "ой", "ий", "й", "иям", "ям", "ием", "ем", "ам", "ом", "о", "у", "ах", "иях", "ях", "ы", "ь", "ию", "ью", "ю", "ия", "ья", "я")
SUPERLATIVE = ("ейш", "ейше")
DERIVATIONAL = ("ост", "ость")

# Suffixes of English and what stands for them, step by step.
POSSESSIVE = ("'s'", "'s", "'")
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
BEFORE_LI = "cdeghkmnrt"
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
SAME = ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")
SAME_AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
EARLY_R1 = ("gener", "commun", "arsen")

# Words too common to be searched for, of three letters and more.
STOP_ENGLISH = frozenset(
    """myself our ours ourselves you your yours yourself yourselves him his himself she her hers herself its itself they them their theirs themselves what which who whom this that these those
    are was were been being have has had having does did doing the and but because until while for with about against between into through during before after above below from down out off over under again further
    then once here there when where why how all any both each few more most other some such nor not only own same than too very can will just don should now""".split()
)
STOP_RUSSIAN = frozenset(
    """что как она так его все это вот меня еще нет ему теперь когда даже вдруг если уже или быть был него вас нибудь опять вам ведь там потом себя ничего может они тут где есть надо ней для тебя чем была сам чтоб без будто чего раз
    тоже себе под будет тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы нее сейчас были куда зачем всех никогда можно при наконец два другой хоть после над больше тот через эти нас про всего них какая много
    разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой более всегда конечно всю между""".split()
)


def _ends(endings: tuple[str, ...]) -> re.Pattern:
    return re.compile(f"(?:{'|'.join(endings)})$")


def _either(pair: tuple[tuple[str, ...], tuple[str, ...]]) -> str:
    return f"(?:(?<=[ая])(?:{'|'.join(pair[0])})|(?:{'|'.join(pair[1])}))"


_RV = re.compile(r"^[^аеиоуыэюя]*[аеиоуыэюя]")
_R = re.compile(r"[аеиоуыэюя][^аеиоуыэюя]")
_GERUND = re.compile(_either(GERUND) + "$")
_ADJECTIVAL = re.compile(f"{_either(PARTICIPLE)}?(?:{'|'.join(ADJECTIVE)})$")
_VERB = re.compile(_either(VERB) + "$")
_REFLEXIVE, _NOUN, _SUPERLATIVE, _DERIVED = map(_ends, (REFLEXIVE, NOUN, SUPERLATIVE, DERIVATIONAL))


def russian(word: str) -> str:
    """Stem of a lower-case Russian word."""
    word = word.replace("ё", "е")
    start = _RV.match(word)
    if not start:
        return word
    head, tail = word[: start.end()], word[start.end() :]
    second = list(_R.finditer(word))
    # R2: after the second vowel that a consonant follows, each search from where the last one ended.
    r2 = second[1].end() if len(second) > 1 else len(word)

    def without(pattern: re.Pattern, text: str) -> str | None:
        found = pattern.search(text)
        return text[: found.start()] if found else None

    cut = without(_GERUND, tail)
    if cut is None:
        shorter = without(_REFLEXIVE, tail)
        tail = tail if shorter is None else shorter
        cut = next((x for x in (without(p, tail) for p in (_ADJECTIVAL, _VERB, _NOUN)) if x is not None), tail)
    tail = cut.removesuffix("и")
    whole = head + tail
    found = _DERIVED.search(whole)
    if found and found.start() >= max(r2, len(head)):
        tail = tail[: found.start() - len(head)]
    if tail.endswith("нн"):
        tail = tail[:-1]
    elif (shorter := without(_SUPERLATIVE, tail)) is not None:
        tail = shorter[:-1] if shorter.endswith("нн") else shorter
    else:
        tail = tail.removesuffix("ь")
    return head + tail


_V = "aeiouy"
_SHORT = re.compile(rf"(?:^[{_V}][^{_V}]|[^{_V}][{_V}][^{_V}wxY])$")
_2, _3, _4 = (_ends(tuple(x)) for x in (STEP_2, STEP_3, STEP_4))


def _regions(word: str) -> tuple[int, int]:
    """Where R1 and R2 begin."""
    early = next((p for p in EARLY_R1 if word.startswith(p)), None)
    step = re.compile(f"[{_V}][^{_V}]")
    first = len(early) if early else (m.end() if (m := step.search(word)) else len(word))
    return first, m.end() if (m := step.search(word, first)) else len(word)


def english(word: str) -> str:
    """Stem of a lower-case English word."""
    if len(word) <= 2 or word in SAME:
        return word
    if word in WHOLE:
        return WHOLE[word]
    # A y that is a consonant is written Y.
    word = re.sub(rf"^y|(?<=[{_V}])y", "Y", word.removeprefix("'"))
    r1, r2 = _regions(word)
    for ending in POSSESSIVE:
        if word.endswith(ending):
            word = word[: -len(ending)]
            break
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and re.search(f"[{_V}]", word[:-2]):
        word = word[:-1]
    if word in SAME_AFTER_1A:
        return word
    if found := re.search("(?:eed|eedly)$", word):
        word = word[: found.start()] + "ee" if found.start() >= r1 else word
    elif (found := re.search("(?:ed|edly|ing|ingly)$", word)) and re.search(f"[{_V}]", word[: found.start()]):
        word = word[: found.start()]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif re.search(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", word):
            word = word[:-1]
        elif len(word) <= r1 and _SHORT.search(word):
            word += "e"
    word = re.sub(rf"(?<=.[^{_V}])[yY]$", "i", word)
    found = _2.search(word)
    if found and found.start() >= r1:
        before = word[found.start() - 1 : found.start()]
        allowed = {"ogi": before == "l", "li": before in BEFORE_LI and before != ""}.get(found[0], True)
        word = word[: found.start()] + STEP_2[found[0]] if allowed else word
    found = _3.search(word)
    if found and found.start() >= (r2 if found[0] == "ative" else r1):
        word = word[: found.start()] + STEP_3[found[0]]
    found = _4.search(word)
    if found and found.start() >= r2 and (found[0] != "ion" or word[: found.start()].endswith(("s", "t"))):
        word = word[: found.start()]
    if word.endswith("e") and (len(word) - 1 >= r2 or (len(word) - 1 >= r1 and not _SHORT.search(word[:-1]))):
        word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str | None:
    """Stem of a lower-case word by its script; None for a word too common to be searched for."""
    if word in STOP_ENGLISH or word in STOP_RUSSIAN:
        return None
    if re.search("[а-яё]", word):
        return russian(word)
    return english(word) if word.isascii() and word.isalpha() else word


def same(word: str) -> str:
    """The word itself, for an index of whole words."""
    return word
