"""License detection by ordered signature rules.

A text is normalised to lower-case words with single spaces.  Rules are regular expressions over that form, each gated
by keywords: a rule runs only where one keyword of each of its gates occurs as a word.  The gate of a license name is
completed from the name's pattern, so that every spelling of it has a keyword.  Detections are intervals of words; among them a
detection inside another one of at least its priority is suppressed (equal intervals and priorities: the earlier rule
stays), so "gpl version 3" inside "lesser gpl version 3 or later" says nothing of its own.

Defined cases: null and empty texts have no words, no labels and score 0; null and repeated keys stay rows of their own;
phrases are found in the whole text, overlaps included; the name of any length inside a sentence belongs to its detection; an empty table gives no rows.
"""

import bisect
import functools
import itertools
import re

import numpy as np
import pyarrow as pa

from kinora.llm.common import keyed_text

#: Phrases that are always reported, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Names of licenses as they are written, in normalised words.  (label, pattern, keywords)
LICENSES = [
    ("mit", r"mit", "mit"),
    ("mit-0", r"mit (?:no attribution|0)", "mit"),
    ("x11", r"(?:x11|mit x11|x consortium)", "x11"),
    ("apache-1", r"apache(?: software)? (?:license )?(?:version |v)?1(?: [01])?", "apache"),
    ("apache-2", r"apache(?: software)? (?:license )?(?:version |v)?2(?: 0)?", "apache"),
    ("apache", r"apache", "apache"),
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd freebsd"),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "bsd"),
    ("0bsd", r"(?:0bsd|bsd zero clause|zero clause bsd)", "0bsd bsd"),
    ("bsd", r"bsd", "bsd"),
    ("isc", r"(?:isc|internet systems consortium)", "isc consortium"),
    ("gpl-1", r"(?:gnu )?(?:gpl|general public license) ?(?:version |v)?1(?: 0)?(?: only| or later)?", "gpl public"),
    ("gpl-2", r"(?:gnu )?(?:gpl|general public license) ?(?:version |v)?2(?: 0)?(?: only| or later)?", "gpl gplv2 public"),
    ("gpl-3", r"(?:gnu )?(?:gpl|general public license) ?(?:version |v)?3(?: 0)?(?: only| or later)?", "gpl gplv3 public"),
    ("gpl", r"(?:gnu gpl|gpl|(?:gnu )?general public license)", "gpl public"),
    ("lgpl-2", r"(?:gnu )?(?:lgpl|library general public license) ?(?:version |v)?2(?: 0)?(?: only| or later)?", "lgpl library"),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?2 1(?: only| or later)?", "lgpl lesser"),
    ("lgpl-3", r"(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?3(?: 0)?(?: only| or later)?", "lgpl lesser"),
    ("lgpl", r"(?:gnu )?(?:lgpl|lesser general public license|library general public license)", "lgpl lesser library"),
    ("agpl-1", r"(?:affero general public license|agpl) ?(?:version |v)?1(?: 0)?", "agpl affero"),
    ("agpl-3", r"(?:gnu )?(?:agpl|affero general public license) ?(?:version |v)?3(?: 0)?(?: only| or later)?", "agpl affero"),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public license)", "agpl affero"),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation license)(?: (?:version |v)?1 [123])?", "gfdl documentation"),
    ("mpl-1.1", r"(?:mozilla public license|mpl) ?(?:version |v)?1 [01]", "mpl mozilla"),
    ("mpl-2", r"(?:mozilla public license|mpl) ?(?:version |v)?2(?: 0)?", "mpl mozilla"),
    ("mpl", r"(?:mozilla public license|mpl)", "mpl mozilla"),
    ("epl-1", r"(?:eclipse public license|epl) ?(?:version |v)?1(?: 0)?", "epl eclipse"),
    ("epl-2", r"(?:eclipse public license|epl) ?(?:version |v)?2(?: 0)?", "epl eclipse"),
    ("epl", r"eclipse public license", "eclipse"),
    ("cpl-1", r"(?:common public license|cpl)(?: (?:version |v)?1(?: 0)?)?", "cpl common"),
    ("cddl-1", r"(?:common development and distribution license|cddl)(?: (?:version |v)?1 [01])?", "cddl distribution"),
    ("eupl", r"(?:european union public license|eupl)(?: (?:version |v)?1 [012])?", "eupl european"),
    ("ms-pl", r"(?:microsoft public license|ms pl)", "microsoft pl"),
    ("ms-rl", r"(?:microsoft reciprocal license|ms rl)", "microsoft rl"),
    ("artistic-1", r"artistic (?:license )?(?:version |v)?1(?: 0)?(?: perl)?", "artistic"),
    ("artistic-2", r"artistic (?:license )?(?:version |v)?2(?: 0)?", "artistic"),
    ("artistic", r"artistic license", "artistic"),
    ("perl", r"same terms as perl(?: itself)?", "perl"),
    ("php-3", r"php (?:license )?(?:version |v)?3(?: 0[01]?)?", "php"),
    ("python-2", r"(?:python software foundation|psf|python)(?: license)?(?: (?:version |v)?2(?: 0)?)?", "python psf"),
    ("ruby", r"ruby", "ruby"),
    ("zlib", r"(?:zlib(?: libpng)?)", "zlib"),
    ("libpng", r"(?:libpng|png reference library)", "libpng png"),
    ("boost-1", r"(?:boost software license|bsl|boost)(?: (?:version |v)?1(?: 0)?)?", "boost bsl"),
    ("unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public license)", "wtfpl fuck"),
    ("beerware", r"beerware|beer ware", "beerware beer"),
    ("openssl", r"(?:openssl|ssleay)", "openssl ssleay"),
    ("ofl-1", r"(?:sil )?(?:open font license|ofl)(?: (?:version |v)?1 [01])?", "ofl font"),
    ("ncsa", r"(?:university of illinois ncsa|ncsa)(?: open source)?", "ncsa"),
    ("postgresql", r"postgresql", "postgresql"),
    ("vim", r"vim", "vim"),
    ("w3c", r"w3c(?: software(?: notice)?)?", "w3c"),
    ("afl-3", r"(?:academic free license|afl)(?: (?:version |v)?[123](?: [01])?)?", "afl academic"),
    ("osl-3", r"(?:open software license|osl)(?: (?:version |v)?[123](?: [01])?)?", "osl open"),
    ("cecill", r"cecill(?: [bc])?(?: (?:version |v)?2(?: [01])?)?", "cecill"),
    ("odbl-1", r"(?:open (?:data commons )?(?:open )?database license|odbl)(?: (?:version |v)?1(?: 0)?)?", "odbl database"),
    ("odc-by", r"(?:open data commons attribution|odc by)(?: (?:version |v)?1(?: 0)?)?", "odc commons"),
    ("pddl", r"(?:public domain dedication and license|pddl)(?: (?:version |v)?1(?: 0)?)?", "pddl domain"),
    ("cc0-1", r"(?:cc0|creative commons zero)(?: (?:version |v)?1(?: 0)?)?(?: universal)?", "cc0 zero"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: (?:version |v)?[1234](?: [05])?)?", "cc creative"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: (?:version |v)?[1234](?: [05])?)?", "sa sharealike share"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: (?:version |v)?[1234](?: [05])?)?", "nd noderivatives noderivs no"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: (?:version |v)?[1234](?: [05])?)?", "nc noncommercial non"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: (?:version |v)?[1234](?: [05])?)?", "sa sharealike share"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: (?:version |v)?[1234](?: [05])?)?", "nd noderivatives noderivs no"),
    ("openrail", r"(?:openrail|responsible ai)(?: m)?", "openrail responsible"),
    ("llama", r"llama(?: [234])?(?: community)?", "llama"),
    ("busl-1", r"(?:business source license|busl)(?: (?:version |v)?1 1)?", "busl business"),
    ("sspl-1", r"(?:server side public license|sspl)(?: (?:version |v)?1(?: 0)?)?", "sspl server"),
    ("elastic-2", r"elastic(?: license)?(?: (?:version |v)?2(?: 0)?)?", "elastic"),
]

# Ways to name a license: (form, before, after, keywords, priority, confidence).
FORMS = [
    ("tag", r"spdx license identifier ", r"", "spdx identifier", 5, 1.0),
    ("notice", r"(?:licensed|released|distributed|available|provided|published|covered)(?: as is)? (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)? ", r"(?: licen[sc]e)?", "licensed released distributed available provided published covered", 3, 0.9),
    ("title", r"", r" licen[sc]e(?: version \d+(?: \d+)?)?", "license licence", 2, 0.7),
    ("field", r"licen[sc]e ", r"", "license licence", 1, 0.5),
]


def bridged(head, tail):
    """``head``, at least one word and ``tail``, whatever the length between: the nearest two, each looked for once."""
    return f"{head} (?:(?!(?:{head}|{tail}) )[^ ]+ )++{tail}"


# Sentences of license texts.  (label, pattern, keywords)
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "permission granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "copyright permission"),
    ("apache-2", r"you may not use this (?:file|work|software) except in compliance with the license", "compliance"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("bsd-3", bridged("neither the names? of", "may be used to endorse or promote products"), "endorse"),
    ("bsd-4", r"all advertising materials mentioning features or use of this software", "advertising"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission purpose"),
    ("gpl", r"this (?:program|file|library) is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute gnu"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lesser library"),
    ("agpl", r"under the terms of the gnu affero general public license", "affero"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("zlib", r"the origin of this software must not be misrepresented", "misrepresented"),
    ("boost-1", r"permission is hereby granted free of charge to any person or organization obtaining a copy", "organization"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0-1", bridged("to the extent possible under law", "has waived all copyright"), "waived"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies", "verbatim"),
    ("ofl-1", r"the font software may be sold as part of a larger software package", "font"),
    ("proprietary", r"all rights reserved", "reserved"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "confidential"),
    ("public-domain", r"(?:placed in|dedicated to|released into|in) the public domain", "domain"),
]
SENTENCE_PRIORITY, SENTENCE_CONFIDENCE = 4, 0.95

#: Upper-case ASCII to lower case, other ASCII than letters and digits to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class Rule:
    def __init__(self, label, pattern, keywords, priority, confidence):
        self.label, self.priority, self.confidence = label, priority, confidence
        self.pattern = re.compile(f"(?<= )(?:{pattern})(?= )".encode())
        self.gates = [frozenset(k.encode().split()) for k in keywords]  # one of each is needed


def spellings(pattern):
    """Every string that a pattern of plain characters, classes, groups, alternatives and ``?`` matches."""

    def alternatives(i):
        out, ways = [], [""]
        while i < len(pattern) and pattern[i] != ")":
            if pattern[i] == "|":
                out, ways, i = out + ways, [""], i + 1
                continue
            if pattern.startswith("(?:", i):
                unit, i = alternatives(i + 3)
            elif pattern[i] == "[":
                end = pattern.index("]", i)
                unit, i = list(pattern[i + 1 : end]), end + 1
            else:
                unit, i = [pattern[i]], i + 1
            if pattern.startswith("?", i):
                unit, i = [*unit, ""], i + 1
            ways = [a + b for a in ways for b in unit]
        return out + ways, i + 1

    return alternatives(0)[0]


@functools.cache
def gate_of(pattern, keywords):
    """The keywords, and the longest word of every spelling of ``pattern`` that has none of them ("gplv1", "agpl3")."""
    words = set(keywords.split())
    for spelling in spellings(pattern):
        own = spelling.split()
        if words.isdisjoint(own):
            words.add(max(own, key=len))
    return " ".join(sorted(words))


def rules():
    """The rules in order: sentences, then every license in every form."""
    out = [Rule(label, p, [k], SENTENCE_PRIORITY, SENTENCE_CONFIDENCE) for label, p, k in SENTENCES]
    for (form, before, after, gate, priority, confidence), (label, name, keywords) in itertools.product(FORMS, LICENSES):
        out.append(Rule(label, f"{before}(?:{name}){after}", [gate_of(name, keywords), gate], priority, confidence))
    return out


class Scanner:
    def __init__(self, base=None, ruleset=None):
        self.base = [(f" {phrase} ".encode(), label) for phrase, label in (BASE if base is None else base).items()]
        self.rules = rules() if ruleset is None else ruleset
        self.by_keyword = {}
        for i, rule in enumerate(self.rules):
            for word in rule.gates[0]:
                self.by_keyword.setdefault(word, []).append(i)
        self.base_words = frozenset(phrase.split()[0] for phrase, _ in self.base)

    def scan(self, text):
        """(n_words, places of base phrases as (word, label), kept detections as (start, end, label, confidence))."""
        words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ")
        words = [w for w in words if w]
        present = {w for w in words if w in self.by_keyword}
        if not present and self.base_words.isdisjoint(words):
            return len(words), [], []
        joined = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)  # word i starts after blank i
        places = []
        for phrase, label in self.base:
            at, found = joined.find(phrase), []
            while at >= 0:
                found.append(at)
                at = joined.find(phrase, at + 1)
            places += [(i, label) for i in np.searchsorted(blanks, found).tolist()]
        seen, found = set(words) if present else (), []
        for i in sorted({i for word in present for i in self.by_keyword[word]}):
            rule = self.rules[i]
            if all(not gate.isdisjoint(seen) for gate in rule.gates[1:]):
                spans = np.array([m.span() for m in rule.pattern.finditer(joined)], np.int64).reshape(-1, 2)
                starts, ends = np.searchsorted(blanks, spans[:, 0] - 1), np.searchsorted(blanks, spans[:, 1])
                found += zip(starts.tolist(), ends.tolist(), itertools.repeat(rule))
        return len(words), places, suppress(found)


def suppress(found):
    """Detections (start, end, rule) that lie in no other one of at least their priority.

    A sweep per priority, from the highest down: by start, longest first, with the furthest end so far, and the furthest end of
    higher priorities up to each start.
    """
    kept, taken = [], []  # taken: intervals of higher priorities by start, with the furthest end up to each
    for _, level in itertools.groupby(sorted(enumerate(found), key=lambda x: (-x[1][2].priority, x[1][0], -x[1][1], x[0])), key=lambda x: x[1][2].priority):
        starts, furthest = [s for s, _ in taken], list(itertools.accumulate((e for _, e in taken), max))
        end_so_far, own = -1, []
        for _, (start, end, rule) in level:
            above = bisect.bisect_right(starts, start)
            if end > end_so_far and not (above and furthest[above - 1] >= end):
                kept.append((start, end, rule.label, rule.confidence))
                own.append((start, end))
            end_so_far = max(end_so_far, end)
        taken = sorted(taken + own)
    return sorted(kept)


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<start:long,end:long,label:string,confidence:double>>"
)


def scan(docs, key="doc_id", text="text", base=None, ruleset=None):
    """One row per document with its base phrases, its labels, the best confidence and the kept spans (in words)."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())])
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    names = [c.split()[0] for c in RESULT.split(", ")][:9]

    def found(arrow):
        scanner = Scanner(base, ruleset)
        for batch in arrow:
            rows = []
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, places, kept = scanner.scan(content)
                at = [p for p, _ in places]
                own = {label for _, label in places}
                score = max([1.0 for _ in own] + [c for *_, c in kept], default=0.0)
                rows.append(
                    (
                        doc_id, n, len(places), min(at, default=None), max(at, default=None),
                        ",".join(sorted(own)), ",".join(sorted(own | {label for _, _, label, _ in kept})), score,
                        [dict(zip(("start", "end", "label", "confidence"), k)) for k in kept],
                    )
                )
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return keyed_text(docs, key, text).mapInArrow(found, RESULT)
