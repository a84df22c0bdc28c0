"""License scans: ordered signature rules behind a keyword prefilter.

A text becomes its words (``[0-9a-z]`` and characters beyond ASCII, A-Z lower-cased) joined by single blanks. The rules
are regular expressions over that string: about two hundred written one by one (sentences of license texts, addresses,
classifiers, identifiers with versions, ways of granting), and the license families below in the general forms in which
licenses are granted, named or tagged. Where no "license" is said, only a short identifier after "under" counts, after
"by" one with a version, so "published by MIT" or "provided by Apache helicopters" are none. A rule runs only if one of its
form's keywords and one of its family's occur; each of its matches contains both.

Detections are intervals of words. A rule with higher priority, then a longer interval, comes first; a later
detection inside an interval that stays is suppressed. The labels of the detections that stay, and those of the base
phrases, are the text's labels; its score is 1 - the product of (1 - weight) over the distinct rules that stay.

Defined results: null and empty texts have no words, labels or places and score 0. Repeated rows are scanned one by
one. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .words import LOWERED

# Fixed: the base phrases and their labels.
BASE = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}

VERSION = r"(?: version| v)?(?: \d+)*(?: or(?: any)? later(?: version)?)?"


class Family(NamedTuple):
    label: str
    keyword: str        # every match of the name contains it, or one of several with | between them
    name: str           # regular expression of the license's name, without its version
    tag: str            # regular expression of its short identifier


FAMILIES = [
    Family("mit", " mit | expat | x11 ", "(?:mit|expat|x11)", "mit"),
    Family("mit-0", "mit no attribution", "mit no attribution", "mit 0"),
    Family("apache", "apache", "apache(?: software)?", r"apache \d(?: \d)?"),
    Family("gpl", "general public", "(?:gnu )?general public", r"gpl \d(?: \d)?(?: only| or later)?"),
    Family("gpl", "gpl", "(?:gnu )?gplv?", r"gplv? ?\d"),
    Family("lgpl", "lesser", "(?:gnu )?lesser general public", r"lgpl \d(?: \d)?(?: only| or later)?"),
    Family("lgpl", "library general", "(?:gnu )?library general public", "lgpl"),
    Family("agpl", "affero", "(?:gnu )?affero general public", r"agpl \d(?: \d)?(?: only| or later)?"),
    Family("gfdl", "free documentation", "(?:gnu )?free documentation", r"gfdl \d(?: \d)?"),
    Family("bsd", "bsd", r"(?:(?:new|modified|revised|simplified|original|free|[234] clause|two clause|three clause) )?bsd(?: [0234] clause)?",
           r"bsd \d clause"),
    Family("isc", "isc", "isc", "isc"),
    Family("mpl", "mozilla", "mozilla public", r"mpl \d \d"),
    Family("epl", "eclipse", "eclipse public", r"epl \d \d"),
    Family("eupl", "european union", "european union public", r"eupl \d \d"),
    Family("cddl", "common development", "common development and distribution", r"cddl \d \d"),
    Family("cpl", "common public", "common public", r"cpl \d \d"),
    Family("artistic", "artistic", "(?:perl|clarified) artistic", r"artistic \d \d"),
    Family("boost", "boost", "boost software", r"bsl \d \d"),
    Family("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    Family("unlicense", "unlicense", "unlicense", "unlicense"),
    Family("wtfpl", "what the fuck", "do what the fuck you want to public", "wtfpl"),
    Family("python", "python", "python(?: software foundation)?", r"psf \d \d"),
    Family("postgresql", "postgresql", "postgresql", "postgresql"),
    Family("openssl", "openssl", "openssl", "openssl"),
    Family("ofl", "open font", "(?:sil )?open font", r"ofl \d \d"),
    Family("bsl", "business source", "business source", r"busl \d \d"),
    Family("sspl", "server side", "server side public", r"sspl \d \d"),
    Family("elastic", "elastic", "elastic", r"elastic \d \d"),
    Family("odbl", "open data", "open (?:data commons )?(?:open )?database", r"odbl \d \d"),
    Family("cc0", "cc0", "cc0", r"cc0 \d \d"),
    Family("cc-by-nc-nd", "nc nd", "cc by nc nd", r"cc by nc nd(?: \d \d)?"),
    Family("cc-by-nc-sa", "nc sa", "cc by nc sa", r"cc by nc sa(?: \d \d)?"),
    Family("cc-by-nc", "by nc", "cc by nc(?! nd| sa)", r"cc by nc(?! nd| sa)(?: \d \d)?"),
    Family("cc-by-nd", "by nd", "cc by nd", r"cc by nd(?: \d \d)?"),
    Family("cc-by-sa", "by sa", "cc by sa", r"cc by sa(?: \d \d)?"),
    Family("cc-by", "cc by", "cc by(?! nc| nd| sa)", r"cc by(?! nc| nd| sa)(?: \d \d)?"),
    Family("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
           "by nc nd"),
    Family("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike", "by nc sa"),
    Family("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?! share| no)", "by nc(?! nd| sa)"),
    Family("cc-by-sa", "creative commons", "creative commons attribution share ?alike", "by sa"),
    Family("cc-by", "creative commons", "creative commons attribution(?! non| share| no)", "by(?! nc| nd| sa)"),
    Family("proprietary", "proprietary", "proprietary", "licenseref proprietary"),
    Family("commercial", "commercial", "commercial", "licenseref commercial"),
]
TAGGED = " spdx licen"
RELEASED = " released | distributed | published | available | provided | open sourced | covered | governed "
RELEASE = r"(?:released|distributed|published|available|provided|made available|open sourced|covered|governed) "
TERMS = r"(?:the )?(?:terms (?:and conditions )?of )?(?:an? |the )?"
NO_OWNER = r"(?! press| university| professors?| students?| researchers?| media| helicopters?| banks?| software foundation(?! licen))"
SCOPE = r"(?: international| unported| generic| public)?"
# Forms: (priority, weight, keyword, regular expression around {name}, {tag} or {vtag}, a tag that has a version). Every match
# contains the keyword, or one of several with | between them. Without the word "license" only short identifiers count.
FORMS = [
    (9, 1.0, TAGGED, r"spdx licen[cs]e identifier {tag}"),
    (8, 0.95, " licensed | licenced ", r"(?:dual |jointly |is |are )?licen[cs]ed (?:to you )?under " + TERMS + r"{name}{v}" + SCOPE + r"(?: licen[cs]e)?{v}"),
    (8, 0.95, " licensed | licenced ", r"(?:dual |jointly |is |are )?licen[cs]ed (?:to you )?(?:under|as) " + TERMS + r"{tag}(?: or later| only)?"),
    (7, 0.9, " licensed| licenced", r"{name}{v} licen[cs]ed" ),
    (7, 0.9, " licensed| licenced", r"{tag} licen[cs]ed"),
    (7, 0.9, RELEASED, RELEASE + r"(?:under|by|subject to|according to) " + TERMS + r"{name}{v}" + SCOPE + r" licen[cs]e{v}"),
    (7, 0.9, RELEASED, RELEASE + r"under " + TERMS + r"{tag}" + NO_OWNER),
    (7, 0.9, RELEASED, RELEASE + r"(?:by|subject to|according to) " + TERMS + r"{vtag}"),
    (6, 0.9, " under the terms | under terms ", r"under (?:the )?(?:terms (?:and conditions )?of )(?:the )?{name}{v} licen[cs]e{v}"),
    (6, 0.9, " under the terms | under terms ", r"under (?:the )?(?:terms (?:and conditions )?of )(?:the )?{tag}" + NO_OWNER),
    (6, 0.85, " licen", r"licen[cs]e (?:is )?(?:the )?{name} licen[cs]e{v}"),
    (6, 0.85, " licen", r"licen[cs]es? (?:is |type |name |id |identifier |expression |spdx )?{tag}" + NO_OWNER
     + r"(?! granted| holds| gave| issued| offers| sells)"),
    (5, 0.8, " licen", r"(?:see|under|uses?|with|accept|read|by) (?:the )?{name} licen[cs]e{v}"),
    (4, 0.7, " licen", r"{name}{v} (?:public )?licen[cs]e{v}"),
    (4, 0.7, " licen", r"{vtag} licen[cs]e"),
]
# Rules of their own: (priority, weight), then lines of label, keyword and regular expression.
RULES = {
    (10, 1.0): r"""
        mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
        mit | the above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies
        mit | without warranty of any kind | the software is provided as is without warranty of any kind express or implied
        isc | permission to use | permission to use copy modify and or distribute this software for any purpose
        isc | disclaims all warranties with regard | the author disclaims all warranties with regard to this software
        bsd | redistribution and use | redistribution and use in source and binary forms with or without modification
        bsd | redistributions of source code must | redistributions of source code must retain the above copyright notice
        bsd | redistributions in binary form must | redistributions in binary form must reproduce the above copyright notice
        bsd | neither the name of | neither the name of (?:\w+ ){1,8}nor the names of its contributors may be used
        bsd | advertising materials mentioning | all advertising materials mentioning features or use of this software
        apache | you may not use this file | you may not use this file except in compliance with the license
        apache | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the license
        apache | www apache org licenses | www apache org licenses license(?: 2 0)?
        gpl | you can redistribute it | you can redistribute it and or modify it under the terms of the gnu general public license
        gpl | received a copy of the gnu general | you should have received a copy of the gnu general public license
        gpl | www gnu org licenses gpl | www gnu org licenses gpl(?: \d)?(?: \d)?
        lgpl | you can redistribute it | you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
        lgpl | received a copy of the gnu l | you should have received a copy of the gnu (?:lesser|library) general public license
        lgpl | www gnu org licenses lgpl | www gnu org licenses lgpl(?: \d)?(?: \d)?
        agpl | you can redistribute it | you can redistribute it and or modify it under the terms of the gnu affero general public license
        agpl | received a copy of the gnu affero | you should have received a copy of the gnu affero general public license
        agpl | www gnu org licenses agpl | www gnu org licenses agpl(?: \d)?(?: \d)?
        gfdl | copy distribute and or modify this document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
        mpl | source code form | this source code form is subject to the terms of the mozilla public license
        mpl | mozilla org mpl | mozilla org mpl(?: \d \d)?
        mpl | mozilla public license | if a copy of the mpl was not distributed with this file you can obtain one at (?:\w+ ){0,6}mozilla public license
        epl | eclipse org legal epl | eclipse org legal epl(?: v\d\d| \d \d)?
        epl | accompanying materials are made available | accompanying materials are made available under the terms of the eclipse public license
        cddl | common development and distribution license the | subject to the terms of the common development and distribution license the license
        artistic | artistic license | this (?:is free software|program is free software) you can redistribute it and or modify it under the (?:same )?terms (?:of|as) (?:the )?(?:perl )?artistic license
        artistic | same terms as perl | under the same terms as perl(?: itself)?
        boost | boost software license | distributed under the boost software license version \d \d
        boost | boost org license | boost org license 1 0 txt
        zlib | without any express or implied warranty | this software is provided as is without any express or implied warranty
        zlib | must not be misrepresented | the origin of this software must not be misrepresented
        unlicense | free and unencumbered | this is free and unencumbered software released into the public domain
        unlicense | unlicense org | unlicense org
        wtfpl | what the fuck you want | you just do what the fuck you want to
        python | python software foundation license | python software foundation license version \d
        openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
        postgresql | without fee and without a written agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
        ofl | sil open font license | this font software is licensed under the sil open font license
        ofl | scripts sil org ofl | scripts sil org ofl
        bsl | business source license | use of this software is governed by the business source license
        sspl | server side public license | terms of the server side public license version \d
        elastic | elastic license | you may not use this file except in compliance with the elastic license(?: 2 0)?
        odbl | opendatacommons org licenses odbl | opendatacommons org licenses odbl(?: 1 0| summary)?
        odbl | made available under the open database | (?:database|data) is made available under the open database license
        public-domain | public domain | (?:dedicated|released|placed|is) (?:in|to|into) the public domain
        cc0 | creativecommons org publicdomain zero | creativecommons org publicdomain zero \d \d
        cc0 | waived all copyright | has waived all copyright and related or neighboring rights
        public-domain | creativecommons org publicdomain mark | creativecommons org publicdomain mark \d \d
        cc-by | creativecommons org licenses by | creativecommons org licenses by(?! nc| nd| sa)(?: \d \d)?
        cc-by-sa | creativecommons org licenses by sa | creativecommons org licenses by sa(?: \d \d)?
        cc-by-nd | creativecommons org licenses by nd | creativecommons org licenses by nd(?: \d \d)?
        cc-by-nc | creativecommons org licenses by nc | creativecommons org licenses by nc(?! nd| sa)(?: \d \d)?
        cc-by-nc-sa | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa(?: \d \d)?
        cc-by-nc-nd | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd(?: \d \d)?
        mit | opensource org licenses mit | opensource org licenses mit
        bsd | opensource org licenses bsd | opensource org licenses bsd(?: \d clause)?
        isc | opensource org licenses isc | opensource org licenses isc
        apache | opensource org licenses apache | opensource org licenses apache(?: 2 0)?
        gpl | opensource org licenses gpl | opensource org licenses gpl(?: \d \d)?
        mpl | opensource org licenses mpl | opensource org licenses mpl(?: \d \d)?""",
    (9, 0.95): r"""
        mit | osi approved mit | license osi approved mit license
        apache | osi approved apache | license osi approved apache software license
        bsd | osi approved bsd | license osi approved bsd license
        isc | osi approved isc | license osi approved isc license
        gpl | osi approved gnu general | license osi approved gnu general public license v\d
        lgpl | osi approved gnu lesser | license osi approved gnu lesser general public license v\d
        agpl | osi approved gnu affero | license osi approved gnu affero general public license v\d
        mpl | osi approved mozilla | license osi approved mozilla public license \d \d
        epl | osi approved eclipse | license osi approved eclipse public license
        python | osi approved python | license osi approved python software foundation license
        artistic | osi approved artistic | license osi approved artistic license
        zlib | osi approved zlib | license osi approved zlib libpng license
        boost | osi approved boost | license osi approved boost software license
        unlicense | osi approved the unlicense | license osi approved the unlicense
        proprietary | other proprietary license | license other proprietary license""",
    (8, 0.9): r"""
        mit | mit or apache 2 | mit or apache 2
        apache | or apache 2 0 | or apache 2 0
        apache | apache 2 0 or | apache 2 0 or
        mit | 2 0 or mit | 2 0 or mit
        mit | mit and bsd | mit and bsd
        mit | either the mit | either the mit(?: licen[cs]e)? or
        gpl | the gnu gpl | under (?:the terms of )?the gnu gpl(?: version \d| v\d| \d)?
        lgpl | the gnu lgpl | under (?:the terms of )?the gnu lgpl(?: version \d| v\d| \d)?
        agpl | the gnu agpl | under (?:the terms of )?the gnu agpl(?: version \d| v\d| \d)?
        gpl | gplv2 | gplv2(?: or later| only)?
        gpl | gplv3 | gplv3(?: or later| only)?
        lgpl | lgplv2 | lgplv2(?: \d)?(?: or later| only)?
        lgpl | lgplv3 | lgplv3(?: or later| only)?
        agpl | agplv3 | agplv3(?: or later| only)?
        gpl | gpl 2 0 | gpl 2 0(?: or later| only)?
        gpl | gpl 3 0 | gpl 3 0(?: or later| only)?
        lgpl | lgpl 2 1 | lgpl 2 1(?: or later| only)?
        lgpl | lgpl 3 0 | lgpl 3 0(?: or later| only)?
        agpl | agpl 3 0 | agpl 3 0(?: or later| only)?
        gfdl | gfdl 1 | gfdl 1 [123](?: or later| only)?
        gpl | gnu gpl v | gnu gpl v\d(?: \d)?
        gpl | gpl version | gpl version \d(?: \d)?(?: or (?:any )?later)?
        lgpl | lgpl version | lgpl version \d(?: \d)?(?: or (?:any )?later)?
        agpl | agpl version | agpl version \d(?: \d)?(?: or (?:any )?later)?
        gpl | general public license version | gnu general public license version \d(?: \d)?(?: or (?:at your option )?any later version)?
        gpl | classpath exception | gpl(?: \d \d)?(?: only| or later)? with classpath exception(?: \d \d)?
        apache | apache licen | apache licen[cs]e version \d(?: \d)?
        apache | apache 2 0 | apache 2 0 (?:and|with|per|for|from|see|copyright|text|file|terms)
        apache | apache 2 licen | apache 2 licen[cs]ed?
        apache | with llvm exception | apache 2 0 with llvm exception
        apache | asl 2 0 | asl 2 0
        bsd | bsd 2 clause | bsd 2 clause(?: licen[cs]e| simplified| freebsd)?
        bsd | bsd 3 clause | bsd 3 clause(?: licen[cs]e| new| clear| revised)?
        bsd | bsd 4 clause | bsd 4 clause(?: licen[cs]e| original| uc)?
        bsd | 0bsd | 0bsd
        bsd | 2 clause bsd | 2 clause bsd(?: style)?
        bsd | 3 clause bsd | 3 clause bsd(?: style)?
        bsd | clause bsd licen | (?:two|three|four|2|3|4) clause bsd licen[cs]e
        bsd | bsd style licen | bsd style licen[cs]e
        mit | mit style licen | mit style licen[cs]e
        mit | expat licen | (?:the )?expat licen[cs]e
        mit | mit x11 | mit x11 licen[cs]e
        mit | x11 style | x11 style licen[cs]e
        mit-0 | mit 0 licen | mit 0 licen[cs]e
        mpl | mpl 2 0 | mpl 2 0
        mpl | mpl 1 1 | mpl 1 1
        mpl | mozilla public licen | mozilla public licen[cs]e(?: version| v)? \d(?: \d)?
        epl | epl 2 0 | epl 2 0
        epl | epl 1 0 | epl 1 0
        epl | eclipse public license | eclipse public license(?: version| v)? \d(?: \d)?
        eupl | eupl 1 | eupl 1 [0-9]
        eupl | european union public licen | european union public licen[cs]e(?: version| v)?(?: \d(?: \d)?)?
        cddl | cddl 1 | cddl 1 [01]
        cpl | cpl 1 0 | cpl 1 0
        artistic | artistic 2 0 | artistic 2 0
        artistic | artistic licen | artistic licen[cs]e (?:version |v )?[12](?: 0)?
        artistic | perl artistic | perl artistic licen[cs]e
        artistic | clarified artistic | clarified artistic licen[cs]e
        boost | bsl 1 0 | bsl 1 0
        boost | boost software licen | boost software licen[cs]e(?: version| v)? 1(?: 0)?
        zlib | zlib libpng licen | zlib libpng licen[cs]e
        zlib | zlib acknowledgement | zlib acknowledgement
        ncsa | university of illinois ncsa | university of illinois ncsa open source licen[cs]e
        ncsa | ncsa open source | ncsa open source licen[cs]e
        afl | academic free licen | academic free licen[cs]e(?: version| v)?(?: \d(?: \d)?)?
        osl | open software licen | open software licen[cs]e(?: version| v)? \d(?: \d)?
        ms-pl | microsoft public licen | microsoft public licen[cs]e
        ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e
        cecill | cecill | cecill(?: [bc])? (?:licen[cs]e|\d \d)
        vim | vim licen | vim licen[cs]e
        ruby | ruby licen | ruby licen[cs]e
        php | php licen | php licen[cs]e(?: version| v)? \d(?: \d+)?
        zpl | zope public | zope public licen[cs]e(?: version| v)?(?: \d(?: \d)?)?
        w3c | w3c software | w3c software (?:notice and )?(?:document )?licen[cs]e
        unicode | unicode licen | unicode licen[cs]e (?:agreement|v3)
        blueoak | blue oak model | blue oak model licen[cs]e
        mulan | mulan psl | mulan psl v\d
        mulan | mulan permissive | mulan permissive software licen[cs]e
        beerware | beer ware | beer ware licen[cs]e
        json | json licen | the software shall be used for good not evil(?: \w+){0,20} json licen[cs]e
        hippocratic | hippocratic licen | hippocratic licen[cs]e(?: \d(?: \d)?)?
        polyform | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter|internal use) licen[cs]e
        commons-clause | commons clause | commons clause licen[cs]e condition
        rail | responsible ai licen | responsible ai licen[cs]es?
        rail | openrail | (?:creativeml |bigscience )?openrail(?: m| s)?
        llama | community license agreement | llama(?: \d)?(?: \d)? community license agreement
        pddl | pddl | pddl 1 0
        pddl | public domain dedication and | public domain dedication and licen[cs]e
        odc-by | odc by | odc by(?: 1 0)?
        odc-by | open data commons attribution | open data commons attribution licen[cs]e
        ogl | open government licen | open government licen[cs]e(?: v\d| version \d)?(?: \d)?
        ogl-game | open game licen | open game licen[cs]e
        fal | free art licen | free art licen[cs]e
        cc0 | cc0 1 0 | cc0 1 0(?: universal)?
        cc0 | cc zero | cc zero
        cc0 | creative commons zero | creative commons zero(?: v?1 0)?
        cc0 | public domain dedication | cc0 (?:\w+ ){0,3}public domain dedication""",
    (7, 0.9): r"""
        cc-by | creative commons attribution | creative commons attribution(?! non| share| no) \d \d
        cc-by-sa | creative commons attribution share | creative commons attribution share ?alike \d \d
        cc-by-nd | creative commons attribution no | creative commons attribution no ?deriv(?:ative)?s? \d \d
        cc-by-nc | creative commons attribution non | creative commons attribution non ?commercial \d \d
        cc-by-nc-sa | creative commons attribution non | creative commons attribution non ?commercial share ?alike \d \d
        cc-by-nc-nd | creative commons attribution non | creative commons attribution non ?commercial no ?deriv(?:ative)?s? \d \d
        cc-by | cc by 4 0 | cc by 4 0
        cc-by | cc by 3 0 | cc by 3 0
        cc-by-sa | cc by sa 4 0 | cc by sa 4 0
        cc-by-sa | cc by sa 3 0 | cc by sa 3 0
        cc-by-nc | cc by nc 4 0 | cc by nc 4 0
        cc-by-nc | cc by nc 3 0 | cc by nc 3 0
        cc-by-nd | cc by nd 4 0 | cc by nd 4 0
        cc-by-nd | cc by nd 3 0 | cc by nd 3 0
        cc-by-nc-sa | cc by nc sa 4 0 | cc by nc sa 4 0
        cc-by-nc-sa | cc by nc sa 3 0 | cc by nc sa 3 0
        cc-by-nc-nd | cc by nc nd 4 0 | cc by nc nd 4 0
        cc-by-nc-nd | cc by nc nd 3 0 | cc by nc nd 3 0""",
    (6, 0.7): r"""
        proprietary | all rights reserved | all rights reserved(?: worldwide)?
        proprietary | confidential | (?:proprietary and confidential|confidential and proprietary)
        proprietary | may not be reproduced | may not be reproduced (?:\w+ ){0,12}without (?:the )?(?:prior |express )?(?:written )?permission
        proprietary | unauthorized copying | unauthorized copying of this (?:file|software|document)
        proprietary | trade secret | contains (?:\w+ ){0,3}trade secrets? of
        proprietary | proprietary licen | (?:under|subject to) (?:a|the) proprietary licen[cs]e
        commercial | commercial licen | (?:under|requires|purchase|obtain|buy) (?:a |the )?commercial licen[cs]e
        commercial | end user licen | end user licen[cs]e agreement
        commercial | licensed not sold | (?:software|product) is licensed not sold""",
}


def _own_rules():
    """(priority, weight, label, keyword, expression) of ``RULES``."""
    for (priority, weight), lines in RULES.items():
        for line in lines.strip().splitlines():
            label, keyword, text = line.strip().split(" | ", 2)
            yield priority, weight, label, keyword, text


def _tag_key(tag: str) -> str:
    """The literal text that a short identifier begins with."""
    plain = re.match(r"[a-z0-9 ]+", tag).group()
    return (plain[:-1] if tag[len(plain):len(plain) + 1] == "?" else plain).rstrip()


class RuleSet(NamedTuple):
    form: tuple[bytes, ...]        # keywords; one of each of the two has to occur
    keywords: tuple[bytes, ...]
    rules: list[tuple[int, float, str, int, re.Pattern]]   # priority, weight, label, number, expression


@functools.lru_cache(maxsize=1)
def rule_sets() -> list[RuleSet]:
    """All rules, by their keywords: every family in every form that fits it, and the rules of their own."""
    out, number = {}, 0
    entries = []
    for f in FAMILIES:
        for priority, weight, k, form in FORMS:
            short = "{name}" not in form
            if "{vtag}" in form and r"\d" not in f.tag or short and k != TAGGED and f.tag.startswith("by"):
                continue                 # "by" alone is no identifier
            entries.append((k, _tag_key(f.tag) if short else f.keyword, priority, weight, f.label,
                            form.format(name=f.name, tag=f.tag, vtag=f.tag, v=VERSION)))
    entries += [(k, k, priority, weight, label, text) for priority, weight, label, k, text in _own_rules()]
    for form, keyword, priority, weight, label, text in entries:
        rule = (priority, weight, label, number, re.compile(rf"(?<= ){text}(?= )".encode()))
        key = tuple(form.encode().split(b"|")), tuple(keyword.encode().split(b"|"))
        out.setdefault(key, []).append(rule)
        number += 1
    return [RuleSet(*k, r) for k, r in out.items()]


class Detection(NamedTuple):
    label: str
    first_word: int
    last_word: int
    rule: int
    weight: float


def normalised(data: bytes) -> tuple[bytes, int]:
    """(the words between single blanks, blanks at both ends; how many words)."""
    words = data.translate(_TABLE).split()
    return b" %s " % b" ".join(words), len(words)


_TABLE = bytes(b or 32 for b in LOWERED.tolist())


def _word_numbers(text: bytes, places: list[int]) -> dict[int, int]:
    """The number of the word that begins at each byte place."""
    out, at, n = {}, 0, -1
    for p in sorted(set(places)):
        n += text.count(b" ", at, p)
        at = p
        out[p] = n
    return out


def detect(text: bytes) -> list[Detection]:
    """The detections that stay, in a text as ``normalised`` gives it."""
    found, seen = [], {}

    def occurs(keywords):
        if keywords not in seen:
            seen[keywords] = any(k in text for k in keywords)
        return seen[keywords]

    for group in rule_sets():
        if occurs(group.form) and occurs(group.keywords):
            for priority, weight, label, number, expression in group.rules:
                found += [(priority, m.start(), m.end(), label, number, weight) for m in expression.finditer(text)]
    found.sort(key=lambda d: (-d[0], d[1] - d[2], d[1], d[4]))
    kept, covered = [], _FurthestEnd([d[1] for d in found])
    for d in found:
        if covered.up_to(d[1]) < d[2]:       # no detection that stays begins no later and ends no earlier
            kept.append(d)
            covered.add(d[1], d[2])
    number = _word_numbers(text, [x for d in kept for x in (d[1], d[2])])
    return [Detection(d[3], number[d[1]], number[d[2]], d[4], d[5]) for d in kept]


class _FurthestEnd:
    """Of the intervals added so far that begin at or before a place, the furthest end (a prefix-maximum tree)."""

    def __init__(self, starts: list[int]):
        self.rank = {s: k for k, s in enumerate(sorted(set(starts)), 1)}
        self.tree = [-1] * (len(self.rank) + 1)

    def add(self, start: int, end: int) -> None:
        k = self.rank[start]
        while k < len(self.tree):
            self.tree[k] = max(self.tree[k], end)
            k += k & -k

    def up_to(self, start: int) -> int:
        k, best = self.rank[start], -1
        while k:
            best = max(best, self.tree[k])
            k -= k & -k
        return best


def base_places(text: bytes) -> tuple[list[int], set[str]]:
    """(the first words of all base phrases, sorted; their labels)."""
    at, labels = [], set()
    for phrase, label in BASE.items():
        whole, p = b" %s " % phrase, -1
        while (p := text.find(whole, p + 1)) >= 0:
            at.append(p + 1)
            labels.add(label)
    numbers = _word_numbers(text, at)
    return sorted(numbers[p] for p in at), labels


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            rows = []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                text, n = normalised(data or b"")
                places, base = base_places(text)
                staying = detect(text)
                miss = 1.0
                for weight in {d.rule: d.weight for d in staying}.values():
                    miss *= 1 - weight
                rows.append((n, len(places), places[0] if places else None, places[-1] if places else None,
                             ",".join(sorted(base)), ",".join(sorted(base | {d.label for d in staying})), 1 - miss))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                                             names=["doc_id", *names])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _scan, "doc_id long, " + RESULT)
