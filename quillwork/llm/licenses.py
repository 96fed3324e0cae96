"""License scans by ordered signature rules (DataFrame operations only).

A text is taken as its words (runs of letters, digits and non-ASCII characters, A-Z lower-cased). Signatures are regexes over
words joined by single spaces; they come in three classes of falling priority: tags and the licences' own sentences, notices
("licensed under the ..."), and bare titles. Each signature has a keyword: words are cut into blocks of `BLOCK` words (with
`TAIL` more, so that nothing is cut apart), only blocks that hold a keyword are looked at, and only by the signatures of the
keywords they hold. A detection inside a detection of the same or a higher class is suppressed (of two equal intervals the
rule that stands first stays), so "lesser general public license" is not also the general one.

A row is a document and is scanned by itself: nothing is shuffled, no group forms.

Defined cases: null text is empty: no words, no places, empty labels, score 0. Rows that share a doc_id, or have none, and
repeated rows are scanned apart. Texts of any length are read whole. Other columns, whatever their names, are left out. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words per block, and how many words the longest match may have.
BLOCK, TAIL = 256, 64

#: Phrases that the base counts, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: A licence's label, the keyword of its titles, its titles, its identifier as words.
TITLES = """
mit | mit | (?:the )?mit (?:open source |style )?licen[sc]e | mit
mit | expat | expat (?:mit )?licen[sc]e | expat
mit-0 | mit | mit no attribution(?: licen[sc]e)? | mit 0
x11 | x11 | (?:mit )?x11 licen[sc]e | x11
apache-2 | apache | apache (?:software )?licen[sc]e (?:version |v )?(?:2|v2)(?: 0)? | apache 2 0
apache-1.1 | apache | apache (?:software )?licen[sc]e (?:version |v )?1 1 | apache 1 1
apache-1.0 | apache | apache (?:software )?licen[sc]e (?:version |v )?1 0 | apache 1 0
apache | apache | apache (?:software )?licen[sc]e | apache
bsd-2-clause | bsd | (?:(?:simplified|freebsd) bsd licen[sc]e|bsd (?:2|two) clause(?: licen[sc]e)?|(?:2|two) clause bsd(?: licen[sc]e)?) | bsd 2 clause(?: freebsd)?
bsd-3-clause | bsd | (?:(?:new|modified|revised) bsd licen[sc]e|bsd (?:3|three) clause(?: licen[sc]e)?|(?:3|three) clause bsd(?: licen[sc]e)?) | bsd 3 clause
bsd-4-clause | bsd | (?:(?:original|old) bsd licen[sc]e|bsd (?:4|four) clause(?: licen[sc]e)?|(?:4|four) clause bsd(?: licen[sc]e)?) | bsd 4 clause(?: uc)?
0bsd | bsd | (?:zero clause bsd(?: licen[sc]e)?|bsd zero clause licen[sc]e|0bsd licen[sc]e) | 0bsd
bsd | bsd | bsd (?:style )?licen[sc]e | bsd
isc | isc | isc licen[sc]e | isc
gpl-1 | gpl | (?:gnu )?gpl (?:version |v )?(?:1|v1)(?: 0)? | gpl 1 0(?: only| or later)?
gpl-2 | gpl | (?:gnu )?gpl (?:version |v )?(?:2|v2)(?: 0)? | gpl 2 0(?: only| or later)?
gpl-3 | gpl | (?:gnu )?gpl (?:version |v )?(?:3|v3)(?: 0)? | gpl 3 0(?: only| or later)?
gpl | gpl | gnu gpl | gpl
gpl-1 | gnu | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:1|v1)(?: 0)? | gnu gpl 1
gpl-2 | gnu | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:2|v2)(?: 0)? | gnu gpl 2
gpl-3 | gnu | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:3|v3)(?: 0)? | gnu gpl 3
gpl | gnu | gnu general public licen[sc]e | gnu gpl
lgpl-2 | lgpl | (?:gnu )?lgpl (?:version |v )?(?:2|v2)(?: 0)? | lgpl 2 0(?: only| or later)?
lgpl-2.1 | lgpl | (?:gnu )?lgpl (?:version |v )?(?:2|v2) 1 | lgpl 2 1(?: only| or later)?
lgpl-3 | lgpl | (?:gnu )?lgpl (?:version |v )?(?:3|v3)(?: 0)? | lgpl 3 0(?: only| or later)?
lgpl | lgpl | gnu lgpl | lgpl
lgpl-2 | gnu | gnu library general public licen[sc]e(?: (?:version |v )?(?:2|v2)(?: 0)?)? | gnu lgpl 2
lgpl-2.1 | gnu | gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:2|v2) 1 | gnu lgpl 2 1
lgpl-3 | gnu | gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:3|v3)(?: 0)? | gnu lgpl 3
lgpl | gnu | gnu lesser general public licen[sc]e | gnu lgpl
agpl-3 | agpl | (?:gnu )?agpl (?:version |v )?(?:3|v3)(?: 0)? | agpl 3 0(?: only| or later)?
agpl-3 | affero | (?:gnu )?affero general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?(?:3|v3)(?: 0)? | affero gpl 3
agpl | affero | (?:gnu )?affero general public licen[sc]e | affero gpl
gfdl-1.1 | gnu | gnu free documentation licen[sc]e (?:version |v )?1 1 | gfdl 1 1(?: only| or later)?
gfdl-1.2 | gnu | gnu free documentation licen[sc]e (?:version |v )?1 2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | gnu | gnu free documentation licen[sc]e (?:version |v )?1 3 | gfdl 1 3(?: only| or later)?
gfdl | gnu | gnu free documentation licen[sc]e | gfdl
mpl-1.1 | mozilla | mozilla public licen[sc]e (?:version |v )?1 1 | mpl 1 1
mpl-2 | mozilla | mozilla public licen[sc]e (?:version |v )?(?:2|v2)(?: 0)? | mpl 2 0
mpl | mozilla | mozilla public licen[sc]e | mpl
epl-1 | eclipse | eclipse public licen[sc]e (?:version |v )?(?:1|v1)(?: 0)? | epl 1 0
epl-2 | eclipse | eclipse public licen[sc]e (?:version |v )?(?:2|v2)(?: 0)? | epl 2 0
epl | eclipse | eclipse public licen[sc]e | epl
edl-1 | eclipse | eclipse distribution licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | edl 1 0
cddl-1 | cddl | cddl (?:version |v )?(?:1|v1)(?: 0)? | cddl 1 0
cddl-1.1 | cddl | cddl (?:version |v )?1 1 | cddl 1 1
cddl | common | common development and distribution licen[sc]e | cddl
cpl-1 | common | common public licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | cpl 1 0
cpal-1 | common | common public attribution licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | cpal 1 0
eupl-1.1 | european | european union public licen[sc]e (?:version |v )?1 1 | eupl 1 1
eupl-1.2 | european | european union public licen[sc]e (?:version |v )?1 2 | eupl 1 2
eupl | european | european union public licen[sc]e | eupl
osl-3 | open | open software licen[sc]e(?: (?:version |v )?(?:3|v3)(?: 0)?)? | osl 3 0
afl-3 | academic | academic free licen[sc]e(?: (?:version |v )?(?:3|v3)(?: 0)?)? | afl 3 0
artistic-1 | artistic | artistic licen[sc]e (?:version |v )?(?:1|v1)(?: 0)? | artistic 1 0(?: perl)?
artistic-2 | artistic | artistic licen[sc]e (?:version |v )?(?:2|v2)(?: 0)? | artistic 2 0
artistic | artistic | (?:perl )?artistic licen[sc]e | artistic
bsl-1 | boost | boost software licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | bsl 1 0
zlib | zlib | zlib (?:libpng )?licen[sc]e | zlib
libpng | libpng | libpng licen[sc]e(?: version 2)? | libpng(?: 2 0)?
unlicense | unlicense | (?:the unlicense|unlicense (?:licen[sc]e|public domain)) | unlicense
wtfpl | wtfpl | wtfpl(?: (?:version |v )?2)?(?: licen[sc]e)? | wtfpl
cc0 | cc0 | (?:cc0|creative commons zero)(?: 1 0)?(?: universal)?(?: licen[sc]e)? | cc0 1 0
cc-by | cc | cc by(?: [1-4] [05])? | cc by [1-4] [05]
cc-by-sa | cc | cc by sa(?: [1-4] [05])? | cc by sa [1-4] [05]
cc-by-nc | cc | cc by nc(?: [1-4] [05])? | cc by nc [1-4] [05]
cc-by-nd | cc | cc by nd(?: [1-4] [05])? | cc by nd [1-4] [05]
cc-by-nc-sa | cc | cc by nc sa(?: [1-4] [05])? | cc by nc sa [1-4] [05]
cc-by-nc-nd | cc | cc by nc nd(?: [1-4] [05])? | cc by nc nd [1-4] [05]
cc-by | creative | creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by
cc-by-sa | creative | creative commons attribution (?:sharealike|share alike)(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by sa
cc-by-nc | creative | creative commons attribution (?:noncommercial|non commercial)(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by nc
cc-by-nd | creative | creative commons attribution (?:noderivatives|noderivs|no derivatives|no derivs)(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by nd
cc-by-nc-sa | creative | creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike)(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by nc sa
cc-by-nc-nd | creative | creative commons attribution (?:noncommercial|non commercial) (?:noderivatives|noderivs|no derivatives|no derivs)(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? | creative commons by nc nd
odbl-1 | open | open (?:data commons open )?database licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | odbl 1 0
odc-by-1 | open | open data commons attribution licen[sc]e(?: (?:version |v )?(?:1|v1)(?: 0)?)? | odc by 1 0
pddl-1 | public | public domain dedication and licen[sc]e | pddl 1 0
ogl-uk-3 | open | open government licen[sc]e (?:version |v )?(?:3|v3)(?: 0)? | ogl uk 3 0
ogl | open | open government licen[sc]e | ogl
ofl-1.1 | sil | sil open font licen[sc]e(?: (?:version |v )?1 1)? | ofl 1 1
psf-2 | python | python (?:software foundation )?licen[sc]e(?: (?:version |v )?2)? | (?:psf|python) 2 0
ruby | ruby | ruby licen[sc]e | ruby
php-3 | php | php licen[sc]e(?: (?:version |v )?3(?: 01| 0)?)? | php 3 01
postgresql | postgresql | postgresql licen[sc]e | postgresql
ncsa | ncsa | (?:university of illinois )?ncsa open source licen[sc]e | ncsa
w3c | w3c | w3c software (?:notice and )?licen[sc]e | w3c
openssl | openssl | openssl licen[sc]e | openssl
qpl-1 | q | q public licen[sc]e(?: (?:version |v )?1 0)? | qpl 1 0
sleepycat | sleepycat | sleepycat licen[sc]e | sleepycat
ms-pl | microsoft | microsoft public licen[sc]e | ms pl
ms-rl | microsoft | microsoft reciprocal licen[sc]e | ms rl
upl-1 | universal | universal permissive licen[sc]e(?: (?:version |v )?1 0)? | upl 1 0
mulan-2 | mulan | mulan (?:psl|permissive software licen[sc]e) (?:version |v )?(?:2|v2) | mulanpsl 2 0
busl-1.1 | business | business source licen[sc]e(?: 1 1)? | busl 1 1
sspl-1 | server | server side public licen[sc]e(?: (?:version |v )?1)? | sspl 1 0
elastic-2 | elastic | elastic licen[sc]e(?: 2 0| v2)? | elastic 2 0
polyform-nc-1 | polyform | polyform (?:noncommercial|non commercial) licen[sc]e(?: 1 0 0)? | polyform noncommercial 1 0 0
openrail-m | openrail | (?:bigscience |creativeml )?(?:openrail|open rail)(?: m)?(?: licen[sc]e)? | openrail m
cecill-2 | cecill | cecill (?:free software )?licen[sc]e(?: agreement)?(?: version 2)? | cecill 2 [01]
lppl-1.3 | latex | latex project public licen[sc]e(?: (?:version |v )?1 3)? | lppl 1 3[ac]
ipl-1 | ibm | ibm public licen[sc]e(?: (?:version |v )?1 0)? | ipl 1 0
"""

#: A licence's label, a keyword and a sentence that stands in its own text only.
SENTENCES = """
mit | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
isc | permission | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | endorse | neither the name of (?:\\S+ ){1,16}may be used to endorse or promote products derived from this software
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
gpl-2 | gnu | gnu general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e or (?:at your option )?any later version
gpl-3 | gnu | gnu general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or (?:at your option )?any later version
lgpl-2.1 | gnu | gnu lesser general public licen[sc]e as published by the free software foundation either version 2 1 of the licen[sc]e or (?:at your option )?any later version
lgpl-3 | gnu | gnu lesser general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or (?:at your option )?any later version
agpl-3 | affero | gnu affero general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or (?:at your option )?any later version
apache-2 | apache | you may obtain a copy of the licen[sc]e at (?:http|https) www apache org licenses license 2 0
mpl-2 | mozilla | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public licen[sc]e version 1 1
epl-1 | eclipse | (?:http|https) www eclipse org legal epl v10
epl-2 | eclipse | (?:http|https) www eclipse org legal epl (?:2 0|v20)
cddl | cddl | the contents of this file are subject to the terms of the common development and distribution licen[sc]e
bsl-1 | boost | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e
bsl-1 | boost | (?:http|https) www boost org license 1 0 txt
zlib | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | wtfpl | do what the fuck you want to public licen[sc]e
cc0 | creativecommons | (?:http|https) creativecommons org publicdomain zero 1 0
cc-by | creativecommons | (?:http|https) creativecommons org licenses by [1-4] [05]
cc-by-sa | creativecommons | (?:http|https) creativecommons org licenses by sa [1-4] [05]
cc-by-nc | creativecommons | (?:http|https) creativecommons org licenses by nc [1-4] [05]
cc-by-nd | creativecommons | (?:http|https) creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa | creativecommons | (?:http|https) creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd | creativecommons | (?:http|https) creativecommons org licenses by nc nd [1-4] [05]
gpl | gnu | (?:http|https) www gnu org licenses gpl
lgpl | gnu | (?:http|https) www gnu org licenses lgpl
agpl | gnu | (?:http|https) www gnu org licenses agpl
mit | opensource | (?:http|https) (?:www )?opensource org licenses mit(?: license)?
bsd-3-clause | opensource | (?:http|https) (?:www )?opensource org licenses bsd 3 clause
bsd-2-clause | opensource | (?:http|https) (?:www )?opensource org licenses bsd 2 clause
odbl-1 | opendatacommons | (?:http|https) (?:www )?opendatacommons org licenses odbl
ofl-1.1 | sil | (?:http|https) scripts sil org ofl
"""

NOTICE = (
    r"(?:licen[sc]ed|released|distributed|published|provided|available|offered|shared|covered|governed|redistributed|used|dual licen[sc]ed) "
    r"(?:(?:to you|for use|only|solely|freely|here|herein|as is) )?(?:under|by|with) (?:(?:the|a|an) )?(?:(?:terms|conditions) (?:and conditions )?of )?(?:(?:the|a|an) )?(?:{})"
)
TAG = r"spdx licen[sc]e identifier (?:{})"
#: What a detection of each class is worth; the base's phrases are worth that of a notice.
WORTH = {1: 1.0, 2: 0.9, 3: 0.6}


def rules() -> list[tuple[str, str, int, str]]:
    """label, keyword, class, regex over words joined by single spaces; in the order in which equal detections win."""
    rows = lambda table: [[c.strip() for c in line.split(" | ")] for line in table.strip().splitlines()]
    sentences = [(label, key, 1, regex) for label, key, regex in rows(SENTENCES)]
    titles = rows(TITLES)
    tags = [(label, "spdx", 1, TAG.format(name)) for label, _, _, name in titles]
    notices = [(label, key, 2, NOTICE.format(title)) for label, key, title, _ in titles]
    return sentences + tags + notices + [(label, key, 3, title) for label, key, title, _ in titles]


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


RULE = "'rule', {}, 'label', {}, 'key', {}, 'class', {}, 'regex', {}"
WHOLE = "(?<= )(?:{})(?= )"
FOUND = "struct<start:int,back:int,class:int,rule:int,label:string>"


def detections(words: Column) -> Column:
    """All matches of the signatures in an array of words: start (in words), back (minus the end), class, rule, label."""
    quoted = lambda x: f"r'{x}'"
    table = F.expr(f"array({', '.join(f'named_struct({RULE.format(i, quoted(label), quoted(key), cls, quoted(WHOLE.format(regex)))})' for i, (label, key, cls, regex) in enumerate(rules()))})")
    keys = F.expr(f"array({', '.join(sorted({quoted(key) for _, key, _, _ in rules()}))})")

    def of_rule(at: Column, text: Column, r: Column) -> Column:
        found = F.regexp_extract_all(text, r["regex"], F.lit(0))
        start = F.struct(F.lit(-1).alias("at"), F.expr(f"cast(array() as array<{FOUND}>)").alias("out"))

        def step(gaps: Column, state: Column, pair: Column) -> Column:
            here = state["at"] + n_spaces(F.get(gaps, pair["i"]))
            end = here + n_spaces(pair["m"])
            one = F.struct((at + here).alias("start"), (-(at + end + 1)).alias("back"), r["class"].alias("class"), r["rule"].alias("rule"), r["label"].alias("label"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one.cast(FOUND))).alias("out"))

        numbered = F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i")))
        walk = let(F.split(text, r["regex"], -1), lambda gaps: F.aggregate(numbered, start, lambda s, x: step(gaps, s, x))["out"])
        return F.when(F.size(found) > 0, F.filter(walk, lambda d: d["start"] < at + BLOCK)).otherwise(start["out"])

    def of_block(at: Column) -> Column:
        def scan(part: Column) -> Column:
            text = F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" "))
            usable = lambda held: F.filter(table, lambda r: F.array_contains(held, r["key"]))
            looked = lambda held: let(text, lambda t: F.flatten(F.transform(usable(held), lambda r: of_rule(at, t, r))))
            return let(F.array_intersect(part, keys), lambda held: F.when(F.size(held) > 0, looked(held)))

        return let(F.slice(words, at + 1, BLOCK + TAIL), scan)

    every = F.filter(F.transform(F.sequence(F.lit(0), F.size(words), F.lit(BLOCK)), of_block), lambda x: x.isNotNull())
    return F.when(F.arrays_overlap(words, keys), F.array_sort(F.flatten(every))).otherwise(F.expr(f"cast(array() as array<{FOUND}>)"))


def kept(found: Column) -> Column:
    """labels and score of the detections that no other of the same or a higher class contains. Detections come by start,
    longer ones first, so one is contained if an earlier one of such a class reaches as far."""
    start = F.struct(F.lit(-1).alias("r1"), F.lit(-1).alias("r2"), F.lit(-1).alias("r3"), F.expr("cast(array() as array<string>)").alias("labels"), F.lit(0.0).alias("score"))

    def step(s: Column, x: Column) -> Column:
        end, cls = -x["back"], x["class"]
        far = F.greatest(s["r1"], F.when(cls >= 2, s["r2"]), F.when(cls >= 3, s["r3"]))
        new = end > far
        reach = [F.when(cls == c, F.greatest(s[f"r{c}"], end)).otherwise(s[f"r{c}"]).alias(f"r{c}") for c in WORTH]
        worth = F.coalesce(*[F.when(cls == c, F.lit(w)) for c, w in WORTH.items()])
        return F.struct(*reach, F.when(new, F.array_union(s["labels"], F.array(x["label"]))).otherwise(s["labels"]).alias("labels"), F.when(new, F.greatest(s["score"], worth)).otherwise(s["score"]).alias("score"))

    return F.aggregate(found, start, step)


def base(text: Column, n_words: Column) -> tuple[Column, Column, Column, Column]:
    """n_base, first_word, last_word and labels of PHRASES; text: words with a space before, between and after them."""
    count, first, last, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        has, mark = F.contains(text, F.lit(f" {phrase} ")), F.lit(f" {phrase} ")
        head, _, rest = phrase.partition(" ")
        ahead = f"(?<= ){head}(?= {rest} )" if rest else f"(?<= ){head}(?= )"
        count.append(F.when(has, F.regexp_count(text, F.lit(ahead))).otherwise(0))
        first.append(F.when(has, n_spaces(F.substring_index(text, f" {phrase} ", 1))))
        last.append(F.when(has, n_words - n_spaces(F.substring_index(text, f" {phrase} ", -1)) - phrase.count(" ") - 1))
        labels.append(F.when(has, F.lit(label)))
    total = count[0]
    for c in count[1:]:
        total = total + c
    return total, F.least(*first), F.greatest(*last), F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and found (every detection, contained ones
    too), one row per row of docs (doc_id, text)."""
    plain = F.btrim(F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), BETWEEN, " "), F.lit(" "))
    own = docs.select("doc_id", plain.alias("plain"))
    own = own.select("doc_id", F.concat(F.lit(" "), "plain", F.lit(" ")).alias("text"), F.when(F.col("plain") == "", F.expr("cast(array() as array<string>)")).otherwise(F.split("plain", " ")).alias("words"))
    own = own.select("doc_id", "text", F.size("words").alias("n_words"), detections(F.col("words")).alias("found"))
    n_base, first, last, labels = base(F.col("text"), F.col("n_words"))
    own = own.select("doc_id", "n_words", n_base.alias("n_base"), first.alias("first"), last.alias("last"), labels.alias("base"), kept(F.col("found")).alias("own"), "found")
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return own.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_base").cast("long").alias("n_base"), F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.array_union("base", "own.labels")).alias("labels"),
        F.greatest(F.col("own.score"), F.when(F.col("n_base") > 0, WORTH[2]).otherwise(0.0)).alias("score"), "found",
    )
