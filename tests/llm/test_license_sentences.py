"""License scans: sentences that grant or name a license, and sentences that only use its words."""

import pytest

from stratum.llm import license_scan

GRANTS = """
mit | This project is MIT-licensed software.
mit | License: MIT
mit | released under the MIT license, see LICENSE for details
mit | The code is available under MIT.
mit | MIT OR Apache-2.0
mit | "license": "MIT",
mit | https://opensource.org/licenses/MIT
mit | License :: OSI Approved :: MIT License
mit | The Expat License applies to this file.
mit | Permission is hereby granted, free of charge, to any person obtaining a copy
mit-0 | under the MIT-0 license
apache | MIT OR Apache-2.0
apache | Apache-2.0 OR MIT
mit | Apache-2.0 OR MIT
bsd | MIT AND BSD-3-Clause
apache | license = "Apache-2.0"
apache | Released under Apache 2.0
apache | Licensed under the Apache License, Version 2.0 (the "License")
apache | You may not use this file except in compliance with the License.
apache | see http://www.apache.org/licenses/LICENSE-2.0
apache | Apache-2.0 licensed
apache | Apache 2 licensed library
gpl | Licensed under GPLv2+
gpl | under the GNU GPL
gpl | This file is GPL-2.0-or-later
gpl | governed by GPL 3
gpl | GNU GPL v3
gpl | GNU General Public License version 3 or any later version
gpl | You should have received a copy of the GNU General Public License along with this program.
gpl | GPL version 2 or later
lgpl | licensed under LGPL-2.1
lgpl | under the terms of the GNU LGPL
lgpl | distributed under the GNU Lesser General Public License v2.1
agpl | SPDX-License-Identifier: AGPL-3.0
agpl | licensed under the AGPLv3
bsd | BSD licensed
bsd | The 3-clause BSD license
bsd | available under BSD 3-Clause
bsd | Redistribution and use in source and binary forms, with or without modification, are permitted
bsd | a BSD-style license
isc | License: ISC
isc | ISC License
mpl | This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
mpl | licensed under the MPL 2.0
epl | made available under the Eclipse Public License 2.0
eupl | Licensed under the EUPL-1.2
boost | Distributed under the Boost Software License, Version 1.0.
zlib | released under the zlib license
unlicense | This is free and unencumbered software released into the public domain.
wtfpl | Do What The Fuck You Want To Public License
python | Python Software Foundation License Version 2
ofl | This Font Software is licensed under the SIL Open Font License, Version 1.1.
bsl | Use of this software is governed by the Business Source License
artistic | the Artistic License 2.0
artistic | under the same terms as Perl itself
cc-by | licensed under a Creative Commons Attribution 4.0 International License
cc-by | This work is licensed under CC BY 4.0.
cc-by-sa | Text is available under the Creative Commons Attribution-ShareAlike License
cc-by-nc | Creative Commons Attribution-NonCommercial 4.0
cc-by-nc | Licensed under CC BY-NC 4.0.
cc-by-nc-sa | https://creativecommons.org/licenses/by-nc-sa/4.0/
cc-by-nc-nd | CC BY-NC-ND 4.0
cc0 | CC0 1.0 Universal
public-domain | This work has been placed in the public domain.
odbl | This database is made available under the Open Database License
gfdl | GFDL 1.3 or later
rail | released under the CreativeML OpenRAIL-M license
proprietary | All rights reserved.
commercial | requires a commercial license
"""

OTHERS = """
The book was published by MIT in 1999.
provided by Apache helicopters
covered by commercial banks
data provided by PostgreSQL
The author took artistic license with the story.
She studied at MIT and later at Stanford.
Apache helicopters were seen over the valley.
The Apache people lived in the southwest.
He lost his driver license in the park.
A fishing license costs ten dollars.
The commercial break lasted three minutes.
They were released under strict conditions.
The pilot was licensed in Canada.
The report was published under a pseudonym.
Published by MIT Press, Cambridge.
The lecture was provided by MIT professors.
The area is governed by the council.
Data are available from the European Union.
The eclipse was visible to the public.
The Eclipse of the sun in 1999 was total.
Mozilla opened a new office in Berlin.
The boost in sales was a surprise.
Python is a language and also a snake.
PostgreSQL and OpenSSL were installed on the server.
The elastic band snapped.
The meeting was open to the general public.
A public license plate was found.
The zip file was distributed by hand.
Creative people share their work.
The commons was used for grazing.
Attribution is hard in such cases.
No derivative was traded that day.
The by-laws were changed by the members.
He was covered by the insurance.
The tax is 2.0 percent.
Version 2.0 was better than version 1.0.
The clause in the contract was unclear.
The third clause of the sentence is long.
The new revised edition came out in May.
The free documentation centre is closed.
Business source materials are scarce.
The server side of the kitchen was busy.
The lesser of two evils.
The library general manager resigned.
Common development goals were agreed.
Common public opinion has shifted.
The open data portal was launched.
The simplified form is on the website.
Original recipes are kept confidential.
Expat families live in this quarter.
The isc of the school met on Monday.
Font sizes were too small.
The provider was licensed by the state.
Licensed plumbers are hard to find.
The game was licensed to a studio in Japan.
The liquor license was revoked.
A license to kill is a film.
Permission was granted to enter the building.
Free of charge for children under five.
Redistribution of wealth was debated.
Source and binary stars were observed.
The software was released in March.
The terms of the peace treaty were harsh.
Use of this road is at your own risk.
"""


def labels(text):
    return {d.label for d in license_scan.detect(license_scan.normalised(text.encode())[0])}


@pytest.mark.parametrize("line", GRANTS.strip().splitlines())
def test_grants_are_found(line):
    label, text = line.split(" | ", 1)
    assert label in labels(text)
    assert label in labels(f"Some words before it. {text} And some words after it.")


@pytest.mark.parametrize("text", OTHERS.strip().splitlines())
def test_other_sentences_have_no_label(text):
    assert labels(text) == set()
    assert labels(f"Some words before it. {text} And some words after it.") == set()


def test_there_are_enough_sentences_and_rules():
    assert len(GRANTS.strip().splitlines()) >= 60 <= len(OTHERS.strip().splitlines())
    assert len(list(license_scan._own_rules())) >= 200


def test_no_rule_of_its_own_is_written_twice():
    rules = [(label, text) for _, _, label, _, text in license_scan._own_rules()]
    assert len(rules) == len(set(rules))
