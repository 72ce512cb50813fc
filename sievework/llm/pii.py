"""Personal information in free text: detection and format-preserving pseudonyms.

Items are found by their general form - a domain after an at sign, groups of digits, a number
beside a street, a given name and a surname - and by what stands around them, then checked
(area rules, Luhn, mod 97, mod 23, digit counts; what names a method, run, ticket or place is no
item). Numbers and dates are replaced by a keyed permutation within their format (Feistel
networks over digits and over letters), so that equal values get equal pseudonyms in every
document; names, addresses and e-mail addresses get keyed tags that are equal for equal values.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "name")
#: Where the key of the pseudonyms is configured; without it each call draws its own, and only its documents are linked.
KEY_SETTING = "spark.sievework.pii.key"

# --- words, as fixed values ---------------------------------------------------

STREETS_EN = "street st avenue ave road rd lane ln drive dr row close court ct place pl square sq terrace way boulevard blvd crescent parkway pkwy alley walk gardens hill quay mews grove highway hwy circle".split()
STREETS_DE = "straße strasse str. gasse weg allee platz ring damm ufer steig pfad".split()
STREETS_FR = "rue avenue av. boulevard bd place impasse chemin quai allée cours route passage square sentier".split()
STREETS_ES = "calle c/ avenida av. avda. plaza paseo camino carrera ronda travesía callejón vía".split()
UNITS = "flat apt apartment unit suite room floor wohnung piso appt".split()
BOXES = ("P. O. Box", "P.O. Box", "P.O.Box", "PO Box", "Post Office Box", "Postfach", "Apartado de Correos", "Apartado", "Casilla", "B.P.", "BP", "Boîte postale", "Aptdo.")

#: Whose a number is, and what it is called; a label is one of the first, perhaps one of the second.
WHOSE = "student staff employee personnel personal member membership patient insurance insurant customer candidate applicant registration enrolment enrollment matriculation national identity citizen resident social\\s+security ssn tax taxpayer tin vat passport visa driver'?s?\\s+licen[cs]e driving\\s+licen[cs]e licen[cs]e nhs medicare".split(" ")
CALLED = "card number numbers no\\.? num\\.? nr\\.? n[°º] id ids identifier code #".split(" ")
#: Labels in one word, and labels of other languages.
LABELS = (
    "iban", "id", "i\\.d\\.", "pesel", "nino", "curp", "cpf", "rut", "bsn", "steuer-?\\s?(?:id|nummer|identifikationsnummer)", "(?:matrikel|personal|ausweis|personalausweis|reisepass|sozialversicherungs|versicherten|mitglieds|kunden)-?(?:nummer|nr\\.?)", "reisepass", "personalausweis",
    "num[ée]ro\\s+(?:d['’]étudiant|étudiant|de\\s+sécurité\\s+sociale|fiscal|de\\s+passeport|de\\s+carte)", "n[°º]\\s?(?:étudiant|d['’]étudiant|fiscal|de\\s+passeport|de\\s+sécurité\\s+sociale)", "passeport(?:\\s+n[°º])?", "carte\\s+d['’]identité", "nir",
    "n[úu]mero\\s+de\\s+(?:estudiante|alumno|pasaporte|identidad|empleado|seguridad\\s+social|matrícula)", "pasaporte", "carn[ée]", "dni", "nie", "nif", "matrícula",
)
#: What stands before numbers that are no one's.
THINGS_NUMBERED = "run ticket checksum build seed version sheet issue commit job order item attempt case score page figure table equation section chapter line step test session request batch hash port room".split()
PHONES = "tel telephone phone mobile cell fax call ring dial reach text whatsapp telefon handy mobil anrufen teléfono telefono móvil llamar téléphone portable appeler tél телефон".split()

#: Words that begin sentences, greet, or join: never part of a name.
NO_NAMES = frozenset(
    "a an the this that these those there then thus here hence since for from with when where while what which who whose why how if in on at by to of and or but not no yes all any both each every some such one two as is are was were be it its he she we you they i my our your their "
    "after before during under over into onto about against between through without within upon up down out off also however therefore moreover because although though unless until whether so let see note given consider suppose assume show find take use using store start next first second last final "
    "dear hello hi hey team thanks thank regards cheers best kind wishes sincerely yours please subject re fwd cc bcc home phone tel fax email mail contact author reviewed corrected corrections seen signed sent send write call ring attn attention prof dr mr mrs ms sir madam herr frau mme sr sra dra "
    "der die das den dem des ein eine einen einem einer wir sie er es ich und oder aber nicht mit von für auf aus bei nach zu zum zur im am an als wie wenn weil dass ohne daraus somit damit also hier nun sei seien korrigiert geprüft unterschrieben verfasst geschrieben gegeben betrachte zeige bestimme vergleiche berechne "
    "le la les un une des du de et ou mais ne pas avec pour par sur dans en on il elle nous vous ils que qui si comme donc alors puisque sans soit considérons montrer comparons calculer corrigé vérifié signé écrit au aux "
    "el los las unos unas y o pero no con para por sobre sin del al se su sus como que cuando donde sea tomando consideremos comparemos calcule corregido revisado firmado escrito según "
    "new north south east west san santa saint los united mount lake port fort upper lower great "
    "january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    "student staff employee member customer patient social security ssn tax tin passport visa licence license card number id dni nie nif iban national identity "
    "answer question problem solution proof result remark example exercise hint theorem lemma corollary definition figure table equation section chapter part appendix step case test score grade code input output error warning info debug true false none null".split()
)
#: What is named after people, in singular; a name before one of these is no person's mention.
NAMED_THINGS = (
    "theorem lemma conjecture hypothesis condensate statistics simulation integration principle law rule criterion condition identity equation inequality formula relation expansion series sum transform transformation operator matrix tensor algebra group space manifold bundle "
    "metric form kernel gauge bound limit ansatz model method scheme algorithm test function distribution process effect constant number factor term correction anomaly symmetry duality mechanism field potential action state basis "
    "representation approximation theory problem paradox product bracket integral determinant polynomial index class map flow point phase transition universality invariant charge university institute college school prize medal lecture street road "
    "théorème lemme loi règle équation formule critère condition identité opérateur modèle méthode théorie limite jauge noyau borne dualité "
    "teorema lema ley regla ecuación fórmula criterio condición identidad operador modelo método teoría límite transformada núcleo cota dualidad"
).split()
NAMED_THINGS_DE = "satz lemma regel gesetz gleichung ungleichung formel operator kriterium bedingung identität grenzwert modell verfahren methode theorie transformation eichung kern schranke dualität".split()
TITLES = "dr prof professor mr mrs ms miss mx sir dame herr frau mme mlle m sr sra srta dra don doña ing mag".split()
#: Words before a name that say who did, got or is something.
AGENTS = "by from to with for of as and at via per than is was am are told asked met saw know knows knew thanks thank cc attn contact author name signed named called dear von vom bei an durch mit für und ist par de pour avec et chez à est por con para y es a der herrn frau demander preguntar nach sie".split()
#: Words after a name that people do; regular past tenses count besides.
DOING = "wrote said told thinks thought found says writes saw met knows knew gave gives sent sends did does has had is was will would can could should took takes made makes went goes came comes lives works who whose and or schrieb sagte hat ist wird a écrit dit escribió dijo ha es".split()
#: Common given names of several languages.
GIVEN = frozenset(
    "james john robert michael william david richard thomas charles daniel matthew anthony mark paul steven andrew george edward brian kevin peter henry adam simon oliver jack harry lucas noah liam ethan "
    "mary patricia jennifer linda elizabeth barbara susan jessica sarah karen lisa nancy emily emma olivia sophia anna maria laura julia alice jane kate helen ruth rachel claire grace hannah lucy "
    "hans klaus jürgen wolfgang stefan andreas markus matthias jens uwe petra ursula monika sabine heike katrin greta ingrid elke jean pierre michel philippe nicolas antoine luc marie nathalie isabelle sophie camille chloé zoé "
    "josé juan carlos luis miguel antonio francisco javier manuel pedro carmen lucía isabel elena pilar rosa giovanni marco luca francesca giulia ivan dmitri sergei alexei olga natasha tatiana svetlana piotr paweł katarzyna agnieszka "
    "lars erik björn sven astrid ingvar oskar wei li ming hiroshi yuki kenji haruto sakura mohammed ahmed ali omar fatima aisha yusuf priya raj amit sanjay anita kofi kwame ama chidi ngozi".split()
)

# --- patterns -----------------------------------------------------------------


def letters(category: str) -> str:
    """All letters of a Unicode category, as the inside of a character class."""
    found, out = [c for c in range(0x250 * 16) if unicodedata.category(chr(c)) in (category, "Lt")], []
    for c in found:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


def either(words, plain: bool = True) -> str:
    """An alternation, longer words first."""
    return "|".join(re.escape(w) if plain else w for w in sorted(words, key=len, reverse=True))


def patterns() -> dict[str, re.Pattern]:
    upper, letter = f"[{letters('Lu')}]", "[^\\W\\d_]"
    part = rf"{upper}(?:['’]?(?:{letter}|[\u0300-\u036f]))+"
    cap = rf"{part}(?:[-‐]{part})*"
    ini = rf"{upper}\.(?:-?{upper}\.)*"
    particle = r"(?:(?:van|von|der|den|de|da|di|del|della|la|dos|du|bin|al|el|zu|ten|ter) ){0,2}"
    dots = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:DOT|dot)\s)"
    ats = r"(?:\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?|\sAT\s|\sat\s(?=[\w-]+\s?(?:[\[({]\s?(?:dot|DOT)\s?[\])}]|\sdot\s)))"
    town = rf"(?:\d{{4,6}} )?{cap}(?:[ -]{cap})?(?: \d{{4,6}})?"
    unit = rf"(?:{either([w.capitalize() for w in UNITS] + UNITS)})\.? \w{{1,5}}"
    label = rf"(?:(?:{either(WHOSE, False)})(?:['’]s)?(?:[\s-]+(?:{either(CALLED, False)}))*|{either(LABELS, False)})(?:\s+(?:{either(CALLED, False)}))*"
    return {
        # the local part ends, and the domain begins, at an at sign
        "local": re.compile(r"(?<![\w.+-])\w(?:[\w.+'-]*\w)?$"),
        "domain": re.compile(r"\w[\w-]*(?:\.[\w-]+)*\.[^\W\d_]{2,}"),
        "at_trigger": re.compile(r"[\[({\s](?:at|AT|@)[\])}\s]"),
        "written": re.compile(rf"(?<![\w.+-])\w(?:[\w.+'-]*\w)?(?:\s(?:dot|DOT)\s\w+)*{ats}\w[\w-]*(?:{dots}[\w-]+)+"),
        # a run of digit groups, wide enough for a phone or an identity number
        "digits": re.compile(r"(?<![\w.,+/-])(?:\+\s?|\(\+?)?\d(?:[\s.\-/()\u2011\u2013]{0,3}\d){6,}"),
        "extension": re.compile(r"\s?(?:ext\.?|x|extension|Durchwahl|poste|int\.?)\s?\d{1,5}\b", re.IGNORECASE),
        "goes_on": re.compile(r"[\w@]|[-.,/:]\d|-\w"),
        "phone_cue": re.compile(rf"\b(?:{either(PHONES)})\b(?:\s(?:me|us|him|her|them|at|on|no|number))*\W{{0,4}}$", re.IGNORECASE),
        "thing": re.compile(rf"(?<![\w.@-])(?:{either(THINGS_NUMBERED)})s?(?:\s?(?:id|no\.?|number|nr\.?|#))?[ :#=(]{{0,3}}\Z", re.IGNORECASE),
        "nanp": re.compile(r"(?:1[\s.-])?\(?[2-9]\d\d\)?(?:(?P<s>[-.\u2011])\d{3}(?P=s)|\s\d{3}[\s-]|\s?[-.]?\s?\d{3}\s?-\s?)\d{4}"),
        # what may be an identity number: capitals and digits in groups
        "coded": re.compile(r"(?<![\w.,/-])(?:[A-Z]{1,4}[ -]?)?\d(?:[ .\-/]?\d|-?[A-Z](?![a-z])){3,24}(?!\w)"),
        "label": re.compile(rf"(?<!\w){label}\s*(?:is|was|ist|est|es|lautet)?\s*[:#=]?\s*$", re.IGNORECASE),
        "ssn": re.compile(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}"),
        "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
        "dni": re.compile(r"(?<!\w)[XYZ\d]-?\d{7}-?[A-Z](?!\w)"),
        "address": re.compile(
            rf"(?<![\w.])(?:"
            rf"(?:{unit},? )?\d{{1,5}}[A-Za-z]?(?:[-/]\d+)? (?:{cap} ){{1,4}}(?:{either(w.capitalize() for w in STREETS_EN)})\b\.?"
            rf"|(?:{either(BOXES)}) ?(?:n° ?|Nr\.? ?)?\d{{1,6}}"
            rf"|(?:{upper}{letter}+[- ])*{upper}{letter}*(?:{either(STREETS_DE)}) \d{{1,4}}[a-z]?"
            rf"|\d{{1,4}}(?: ?(?:bis|ter|[a-z]\b))?,? (?:{either(STREETS_FR)}) (?:(?:de la|de l['’]|des|du|de|d['’]) ?)?{cap}(?: (?:(?:de|des|du|la|le|les) )*{cap})*"
            rf"|(?:{either(w[:1].upper() + w[1:] for w in STREETS_ES)}) (?:(?:de|del|la|las|los|el) )*{cap}(?: (?:(?:de|del|la|las|los|el) )*{cap})*,? (?:n° ?|núm\.? ?)?\d{{1,4}}[a-z]?"
            rf")"
        ),
        # what follows a street: unit, town and code
        "address_tail": re.compile(rf"(?:,? {unit})?(?:, {town})?"),
        "name": re.compile(rf"(?<![\w.@/\\-])(?:(?P<first>{cap})(?: {ini})*,? (?P<particle>{particle})(?P<second>{cap})(?: {ini}(?= ?[^\w ]|$))?(?: (?P<third>{cap}))?|(?P<i>{ini})(?: ?{ini})* {particle}(?P<last>{cap})|(?P<sur>{cap}), {ini}(?: ?{ini})*)"),
        "title": re.compile(rf"\b(?:{either(TITLES)})\b\.?\s+$", re.IGNORECASE),
        "named_thing": re.compile(rf"(?:['’]s?)? (?:[a-zà-ÿ]+[ -])?(?:{either(NAMED_THINGS)}|{either(w.capitalize() for w in NAMED_THINGS_DE)})(?:s|e|en|n)?\b"),
        "determiner": re.compile(r"\b(?:the|an?|this|that|der|die|das|den|dem|des|eine?[nmrs]?|les?|la|une?|el|los|las|una)\s+$", re.IGNORECASE),
        "agent": re.compile(rf"(?:\b(?:{either(AGENTS)})\s+|[:=(\"“«<]\s*)$", re.IGNORECASE),
        "valediction": re.compile(r"(?:wishes|regards|sincerely|cheers|yours|thanks|best|grüße|gruß|cordialement|saludos|atentamente),?\s*$", re.IGNORECASE),
        "does": re.compile(rf"\s+(?:{either(DOING)}|[a-zäöüéèáíóú]{{2,}}(?:ed|te|ó))\b"),
        "and_before": re.compile(r"(?:\band|\bund|\bet|\by|&|,)\s+$"),
        "date": re.compile(r"\b(?:born(?: on)?|birth(?:day|date)?|date of birth|dob|geboren(?: am)?|geburtsdatum|née?(?: le)?|nacid[oa](?: el)?|fecha de nacimiento)\W{0,3}(?P<v>\d{4}-\d{2}-\d{2})", re.IGNORECASE),
    }


# --- checks of numbers ----------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_holds(value: str) -> bool:
    plain = value.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def dni_holds(value: str) -> bool:
    """Spanish numbers: the letter is the number's remainder by 23."""
    plain = value.replace("-", "")
    number = plain[:-1].translate({ord("X"): "0", ord("Y"): "1", ord("Z"): "2"})
    return number.isdigit() and "TRWAGMYFPDXBNJZSQVHLCKE"[int(number) % 23] == plain[-1]


def is_phone(value: str, cued: bool, p: dict[str, re.Pattern]) -> bool:
    """Whether a run of digit groups is a phone number: an international, national or North American notation, or any after a cue."""
    digits = [c for c in value if c.isdecimal()]
    if not 7 <= len(digits) <= 15:
        return False
    groups = re.split(r"[\s.\-/()]+", value.strip("()+ "))
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) or value.count("(") != value.count(")"):
        return False
    if cued or value.startswith(("+", "(+")):
        return True
    if len(groups) == 1:
        return False
    if p["nanp"].fullmatch(value):
        return True
    if value[0] == "(":
        return len(groups[0]) <= 5
    # international by 00, or a national trunk 0
    return value[0] == "0" and len(digits) >= 9 and len(groups[0]) >= 3 and all(2 <= len(g) <= 5 for g in groups[1:]) and "." not in value


# --- finding ----------------------------------------------------------------------


def first_alnum(text: str, start: int, end: int) -> int:
    while start < end and not text[start].isalnum():
        start += 1
    return start


class Spans:
    """Items found so far in a text; overlaps are decided by who comes first in the code."""

    def __init__(self, text: str) -> None:
        self.text, self.items, self.taken = text, [], bytearray(0)

    def add(self, kind: str, start: int, end: int) -> None:
        start = first_alnum(self.text, start, end)
        if start >= end:
            return
        if not self.taken:
            self.taken = bytearray(len(self.text))
        if not any(self.taken[start:end]):
            self.taken[start:end] = b"\x01" * (end - start)
            self.items.append((kind, start, end))

    def free(self, start: int, end: int) -> bool:
        return not self.taken or not any(self.taken[start:end])


def emails(text: str, p: dict[str, re.Pattern], out: Spans) -> None:
    at = text.find("@")
    while at >= 0:
        left = p["local"].search(text, max(0, at - 80), at)
        right = p["domain"].match(text, at + 1) if left else None
        if right:
            out.add("email", left.start(), right.end())
        at = text.find("@", at + 1)
    if p["at_trigger"].search(text):
        for m in p["written"].finditer(text):
            out.add("email", *m.span())


def identity_numbers(text: str, p: dict[str, re.Pattern], out: Spans) -> None:
    for m in p["iban"].finditer(text):
        if iban_holds(m.group()):
            out.add("id_number", *m.span())
    for m in p["coded"].finditer(text):
        value, start = m.group(), m.start()
        word = re.match(r"([A-Z]{2,4})[ -]", value)
        if word and p["label"].fullmatch(word.group(1)):
            # the capitals are the label
            start += word.end()
            value = text[start : m.end()]
        digits = "".join(c for c in value if c.isdecimal())
        if len(digits) < 5:
            continue
        before = text[max(0, start - 48) : start]
        label = p["label"].search(before)
        if label:
            # a label of a run, ticket or the like is no person's
            if not p["thing"].search(before, 0, label.start()) and not (len(digits) > 6 and p["phone_cue"].search(before)):
                out.add("id_number", start, m.end())
        elif p["thing"].search(before):
            continue
        elif p["ssn"].fullmatch(value) or (p["dni"].fullmatch(value) and dni_holds(value)) or (13 <= len(digits) <= 19 and len(value) - len(digits) <= 4 and value[:1] in "3456" and luhn(digits)):
            out.add("id_number", start, m.end())


def phones(text: str, p: dict[str, re.Pattern], out: Spans) -> None:
    for m in p["digits"].finditer(text):
        start, end = m.span()
        before = text[max(0, start - 40) : start]
        if p["goes_on"].match(text, end) or p["thing"].search(before):
            continue
        if is_phone(m.group(), p["phone_cue"].search(before) is not None, p):
            more = p["extension"].match(text, end)
            out.add("phone", start, more.end() if more else end)


#: One of these is in every text with an address: a quick test before the pattern is tried.
STREET_MARKS = (
    *(f" {w.capitalize()}" if len(w) > 2 else f" {w.capitalize()}{e}" for w in STREETS_EN for e in ("", *" .,;\n") if (len(w) > 2) == (e == "")),
    *(f"{w} " for w in STREETS_DE), *(f" {w} " for w in STREETS_FR), *(w[:1].upper() + w[1:] for w in STREETS_ES), *BOXES,
)


def addresses(text: str, p: dict[str, re.Pattern], out: Spans) -> None:
    if not any(word in text for word in STREET_MARKS):
        return
    for m in p["address"].finditer(text):
        out.add("address", m.start(), p["address_tail"].match(text, m.end()).end())


def names(text: str, p: dict[str, re.Pattern], out: Spans) -> None:
    """Names by their form and surroundings.

    In the middle of a sentence two capitalised words that are no common ones name a person
    unless an article stands before or a thing named after people behind. At its beginning,
    or in the order surname, given name, or with initials, something must speak for a person:
    a given name, a title, a word before or behind, or an item beside.
    """
    pos = 0
    while m := p["name"].search(text, pos):
        start, end = m.span()
        first, second, last = m["first"], m["second"], m["last"] or m["sur"]
        if m["third"] and (m["third"].lower() in NO_NAMES or p["does"].match(" " + m["third"].lower()) or not (re.match(r"\s*(?:[^\w\s]|$)", text[end : end + 3]) or p["does"].match(text, end))):
            end = m.start("third") - 1
        pos = end
        if first and first.lower() in NO_NAMES:
            pos = m.end("first")
            continue
        at_start = not text[:start].rstrip(" ")[-1:].strip(".!?:;|\n")
        if first and m["particle"] and at_start and first.lower() not in GIVEN and not p["does"].match(text, end):
            # a participle and "von" rather than a name with its particle
            pos = m.end("first")
            continue
        parts = [w for w in (first, second, last) if w]
        if any(w.lower() in NO_NAMES or w.lower() in NAMED for w in parts):
            # the second word may begin another name
            pos = m.end("first") if first else m.end("i") if m["i"] else end
            continue
        before, behind = text[max(0, start - 40) : start], text[end : end + 48]
        titled = p["title"].search(before) is not None
        if not titled and (p["determiner"].search(before) or p["named_thing"].match(behind)):
            pos = m.end("first") if first and m["particle"] else end
            continue
        stripped = before.rstrip()
        mid = stripped[-1:].islower() or stripped[-1:] in ",(\"“«=<&"
        agent = p["agent"].search(before) is not None
        beside = any(0 <= start - e <= 3 or 0 <= s - end <= 3 for _, s, e in out.items)
        if m["third"] and end < m.start("third") and m["third"].lower() in NAMED and not titled and not p["valediction"].search(before):
            continue
        signed = p["valediction"].search(before) is not None
        does = p["does"].match(behind) is not None
        known = any(w.split("-")[0].lower() in GIVEN for w in parts)
        comma = m["sur"] is not None or (first is not None and "," in text[m.end("first") : m.start("second")])
        if comma:
            speaks = titled or agent or beside or signed or (known and mid) or (does and at_start)
        elif m["i"]:
            speaks = titled or signed or (mid or agent or beside or does) and not re.search(r"[\d$}%] *\Z", before)
        elif at_start:
            speaks = titled or agent or beside or signed or known or does
        else:
            speaks = titled or agent or signed or beside or known or mid or does
        if speaks:
            out.add("name", start, end)
        else:
            pos = m.end("first") if first else m.end("i") if m["i"] else end


NAMED = frozenset(TITLES) | frozenset(NAMED_THINGS) | frozenset(NAMED_THINGS_DE) | frozenset(STREETS_EN)


def find(text: str | None, p: dict[str, re.Pattern]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every item, in order, without overlaps; null or empty: none."""
    if not text:
        return []
    out = Spans(text)
    emails(text, p, out)
    identity_numbers(text, p, out)
    addresses(text, p, out)
    phones(text, p, out)
    names(text, p, out)
    return sorted(out.items, key=lambda x: x[1])


# --- pseudonyms ---------------------------------------------------------------


def keyed(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.blake2b).digest()[:16], "big")


def permute(values: list[int], base: int, key: bytes, tweak: str) -> list[int]:
    """A keyed bijection on the strings of one length over ``base`` symbols (unbalanced Feistel, ten rounds)."""
    n = len(values)
    if n <= 1:
        return [(v + keyed(key, tweak, base, "one")) % base for v in values]
    number = lambda some: sum(v * base**k for k, v in enumerate(reversed(some)))
    u, v = n // 2, n - n // 2
    a, b = number(values[:u]), number(values[u:])
    for i in range(10):
        a, b = b, (a + keyed(key, tweak, base, n, i, b)) % base ** (u if i % 2 == 0 else v)
    return [a // base**k % base for k in reversed(range(u))] + [b // base**k % base for k in reversed(range(v))]


def restore(values: list[int], base: int, key: bytes, tweak: str) -> list[int]:
    """The inverse of ``permute``."""
    n = len(values)
    if n <= 1:
        return [(v - keyed(key, tweak, base, "one")) % base for v in values]
    number = lambda some: sum(v * base**k for k, v in enumerate(reversed(some)))
    u, v = n // 2, n - n // 2
    a, b = number(values[:u]), number(values[u:])
    for i in reversed(range(10)):
        a, b = (b - keyed(key, tweak, base, n, i, a)) % base ** (u if i % 2 == 0 else v), a
    return [a // base**k % base for k in reversed(range(u))] + [b // base**k % base for k in reversed(range(v))]


def permute_number(value: str, key: bytes, tweak: str, by=permute) -> str:
    """Digits become digits of their script and A-Z, a-z letters of their case; all else stays.

    Equal numbers get equal digits in whatever script and grouping they are written.
    """
    digits = by([unicodedata.decimal(c) for c in value if c.isdecimal()], 10, key, tweak)
    letters_ = by([ord(c.upper()) - 65 for c in value if c.isascii() and c.isalpha()], 26, key, tweak)
    next_digit, next_letter = iter(digits), iter(letters_)
    out = []
    for c in value:
        if c.isdecimal():
            out.append(chr(ord(c) - unicodedata.decimal(c) + next(next_digit)))
        elif c.isascii() and c.isalpha():
            out.append(chr((65 if c.isupper() else 97) + next(next_letter)))
        else:
            out.append(c)
    return "".join(out)


FIRST_DAY, DAYS = date(1900, 1, 1), 73049  # 1900-01-01 to 2099-12-31


def permute_date(value: str, key: bytes) -> str:
    """A keyed permutation of the days of 1900 to 2099 (cycle walking); other dates permute as digits."""
    try:
        day = (date.fromisoformat(value) - FIRST_DAY).days
    except ValueError:
        return permute_number(value, key, "date")
    if not 0 <= day < DAYS:
        return permute_number(value, key, "date")
    while True:
        day = int("".join(map(str, permute([int(c) for c in f"{day:05d}"], 10, key, "day"))))
        if day < DAYS:
            return (FIRST_DAY + timedelta(day)).isoformat()


def placeholder(kind: str, value: str, key: bytes) -> str:
    """What stands for an item: <PHONE 020 1234 5678>, <NAME 3f9a1c02>, ..."""
    if kind in ("phone", "id_number"):
        # the word before an extension is no part of the number
        cut_at = re.search(r"\s?(?:ext|x|Durchwahl|poste|int)", value, re.IGNORECASE) if kind == "phone" else None
        number, rest = (value[: cut_at.start()], value[cut_at.start() :]) if cut_at else (value, "")
        mark = re.search(r"\d+$", rest)
        rest = rest[: mark.start()] + permute_number(mark.group(), key, "extension") if mark else rest
        return f"<{kind.upper()} {permute_number(number, key, kind)}{rest}>"
    same = " ".join(value.casefold().split())
    if kind == "name":
        same = " ".join(sorted(re.findall(r"[^\W\d_](?:[^\W\d_]|['’-])*", same)))
    return f"<{kind.upper()} {keyed(key, kind, same) % 16**8:08x}>"


def redact(text: str | None, items: list[tuple[str, int, int]], key: bytes, p: dict[str, re.Pattern]) -> str | None:
    if text is None:
        return None
    out, last = [], 0
    marked = list(items) + [("date", *m.span("v")) for m in p["date"].finditer(text)]
    for kind, start, end in sorted(marked, key=lambda x: x[1]):
        if start < last:
            continue
        out.append(text[last:start])
        out.append(f"<DATE {permute_date(text[start:end], key)}>" if kind == "date" else placeholder(kind, text[start:end], key))
        last = end
    return "".join(out) + text[last:]


# --- operators ------------------------------------------------------------------


def items_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, start_pos, end_pos): one row per item, positions in code points.

    Null, empty and blank texts have no items; repeated rows give repeated items; formulas
    and code are searched like all else. One narrow pass over whole texts.
    """

    def run(frames):
        p = patterns()
        for frame in frames:
            rows = [(i, *item) for i, text in zip(frame["id"], frame["text"]) for item in find(text, p)]
            yield pd.DataFrame(rows, columns=["id", "kind", "start_pos", "end_pos"])

    source = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInPandas(run, "id bigint, kind string, start_pos bigint, end_pos bigint").withColumnRenamed("id", id_col)


def key_of(spark: SparkSession) -> str:
    """The configured key, or one drawn for this call."""
    return spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> DataFrame:
    """(id, text, n_items): each text with typed placeholders, null texts as null, all else unchanged.

    ``key`` is the session's ``spark.sievework.pii.key`` unless given; without either one is
    drawn, so that pseudonyms are linked within the result and to nothing else.
    """
    secret = (key or key_of(df.sparkSession)).encode()

    def run(frames):
        p = patterns()
        for frame in frames:
            found = [find(text, p) for text in frame["text"]]
            texts = [redact(text, items, secret, p) for text, items in zip(frame["text"], found)]
            yield pd.DataFrame({"id": frame["id"], "text": pd.Series(texts, dtype=object), "n_items": [len(x) for x in found]})

    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInPandas(run, "id bigint, text string, n_items bigint").withColumnRenamed("id", id_col)
