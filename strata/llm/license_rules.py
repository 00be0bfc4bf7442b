"""Signature rules of license texts, in order: label | weight | keyword | pattern.

Patterns run over a text's words, lower-case, with one space between (so "2.0" reads "2 0"); a rule is tried only on texts that hold its
keyword, a whole word. The weight, 0 to 100, is the rule's priority and its certainty: tags and grants above names, names above mentions.
Rules of equal weight keep this order.
"""

RULES = r"""
apache-2.0 | 99 | spdx | spdx license identifier apache 2 0
mit-0 | 99 | spdx | spdx license identifier mit 0
mit | 99 | spdx | spdx license identifier mit(?= )
isc | 99 | spdx | spdx license identifier isc
bsd-2-clause | 99 | spdx | spdx license identifier bsd 2 clause
bsd-3-clause | 99 | spdx | spdx license identifier bsd 3 clause
bsd-4-clause | 99 | spdx | spdx license identifier bsd 4 clause
0bsd | 99 | spdx | spdx license identifier 0bsd
gpl-2.0-only | 99 | spdx | spdx license identifier gpl 2 0(?: only)?(?! or later)
gpl-2.0-or-later | 99 | spdx | spdx license identifier gpl 2 0 or later
gpl-3.0-only | 99 | spdx | spdx license identifier gpl 3 0(?: only)?(?! or later)
gpl-3.0-or-later | 99 | spdx | spdx license identifier gpl 3 0 or later
lgpl-2.1-only | 99 | spdx | spdx license identifier lgpl 2 1(?: only)?(?! or later)
lgpl-2.1-or-later | 99 | spdx | spdx license identifier lgpl 2 1 or later
lgpl-3.0-only | 99 | spdx | spdx license identifier lgpl 3 0(?: only)?(?! or later)
lgpl-3.0-or-later | 99 | spdx | spdx license identifier lgpl 3 0 or later
agpl-3.0-only | 99 | spdx | spdx license identifier agpl 3 0(?: only)?(?! or later)
agpl-3.0-or-later | 99 | spdx | spdx license identifier agpl 3 0 or later
mpl-1.1 | 99 | spdx | spdx license identifier mpl 1 1
mpl-2.0 | 99 | spdx | spdx license identifier mpl 2 0
epl-1.0 | 99 | spdx | spdx license identifier epl 1 0
epl-2.0 | 99 | spdx | spdx license identifier epl 2 0
cddl-1.0 | 99 | spdx | spdx license identifier cddl 1 0
cddl-1.1 | 99 | spdx | spdx license identifier cddl 1 1
bsl-1.0 | 99 | spdx | spdx license identifier bsl 1 0
unlicense | 99 | spdx | spdx license identifier unlicense
wtfpl | 99 | spdx | spdx license identifier wtfpl
zlib | 99 | spdx | spdx license identifier zlib
artistic-2.0 | 99 | spdx | spdx license identifier artistic 2 0
cc0-1.0 | 99 | spdx | spdx license identifier cc0 1 0
cc-by-3.0 | 99 | spdx | spdx license identifier cc by 3 0
cc-by-4.0 | 99 | spdx | spdx license identifier cc by 4 0
cc-by-sa-3.0 | 99 | spdx | spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | 99 | spdx | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | 99 | spdx | spdx license identifier cc by nc 4 0
cc-by-nd-4.0 | 99 | spdx | spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0 | 99 | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 | 99 | spdx | spdx license identifier cc by nc nd 4 0
eupl-1.2 | 99 | spdx | spdx license identifier eupl 1 2
ms-pl | 99 | spdx | spdx license identifier ms pl
ms-rl | 99 | spdx | spdx license identifier ms rl
ofl-1.1 | 99 | spdx | spdx license identifier ofl 1 1
postgresql | 99 | spdx | spdx license identifier postgresql
python-2.0 | 99 | spdx | spdx license identifier (?:python|psf) 2 0
blueoak-1.0.0 | 99 | spdx | spdx license identifier blueoak 1 0 0
sspl-1.0 | 99 | spdx | spdx license identifier sspl 1 0
busl-1.1 | 99 | spdx | spdx license identifier busl 1 1
odbl-1.0 | 99 | spdx | spdx license identifier odbl 1 0
mulanpsl-2.0 | 99 | spdx | spdx license identifier mulanpsl 2 0
other-spdx | 60 | spdx | spdx license identifier \w+
apache-2.0 | 95 | apache | licensed under the apache license version 2 0
apache-2.0 | 95 | apache | you may not use this file except in compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0
apache-2.0 | 93 | apache | apache license version 2 0 january 2004
apache-2.0 | 85 | apache | apache (?:software )?license (?:version |v )?2 0
apache-2.0 | 84 | apache | apache (?:software )?license (?:version |v )?2(?! 0)
apache-2.0 | 82 | apache | www apache org licenses license 2 0
apache-2.0 | 80 | asl2 | asl2 0
apache-1.1 | 85 | apache | apache (?:software )?license (?:version |v )?1 1
apache-1.0 | 85 | apache | apache (?:software )?license (?:version |v )?1 0
apache-1.1 | 82 | apache | www apache org licenses license 1 1
apache | 55 | apache | (?:released|distributed|available|published|licensed) under (?:the )?apache
apache | 50 | apache | apache (?:public )?license
mit | 95 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 90 | permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 85 | mit | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit license
mit | 80 | mit | opensource org licenses mit
mit | 70 | mit | license mit(?= )
mit | 70 | mit | mit licensed
mit | 65 | mit | (?:the )?mit license
mit | 60 | x11 | (?:mit x11|x11) license
mit | 60 | expat | expat license
mit-0 | 85 | mit | mit (?:license )?no attribution
isc | 95 | permission | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
isc | 80 | isc | (?:licensed|released|distributed) under (?:the )?isc
isc | 70 | isc | isc license
isc | 75 | isc | opensource org licenses isc
bsd | 95 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 94 | neither | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote
bsd-4-clause | 94 | advertising | all advertising materials mentioning features or use of this software must display
bsd-2-clause | 85 | bsd | (?:2|two) clause bsd
bsd-2-clause | 85 | bsd | bsd (?:2|two) clause
bsd-2-clause | 84 | bsd | simplified bsd license
bsd-2-clause | 84 | freebsd | freebsd license
bsd-3-clause | 85 | bsd | (?:3|three) clause bsd
bsd-3-clause | 85 | bsd | bsd (?:3|three) clause
bsd-3-clause | 84 | bsd | (?:new|modified|revised) bsd license
bsd-4-clause | 85 | bsd | (?:4|four) clause bsd
bsd-4-clause | 85 | bsd | bsd (?:4|four) clause
bsd-4-clause | 84 | bsd | (?:original|old) bsd license
0bsd | 85 | bsd | (?:zero clause bsd|bsd zero clause)
bsd | 75 | bsd | (?:licensed|released|distributed) under (?:the |a )?bsd
bsd | 60 | bsd | bsd (?:style )?license
gpl | 95 | gnu | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2.0-or-later | 94 | gnu | gnu general public license .{0,60}?either version 2 (?:of the license )?or (?:at your option )?any later version
gpl-3.0-or-later | 94 | gnu | gnu general public license .{0,60}?either version 3 (?:of the license )?or (?:at your option )?any later version
gpl-1.0-or-later | 94 | gnu | gnu general public license .{0,60}?either version 1 (?:of the license )?or (?:at your option )?any later version
gpl-2.0 | 92 | gnu | gnu general public license version 2 june 1991
gpl-3.0 | 92 | gnu | gnu general public license version 3 29 june 2007
gpl-1.0 | 92 | gnu | gnu general public license version 1 february 1989
gpl-2.0 | 85 | gnu | gnu (?:general public license|gpl) (?:version |v )?2(?: 0)?
gpl-3.0 | 85 | gnu | gnu (?:general public license|gpl) (?:version |v )?3(?: 0)?
gpl-2.0 | 80 | gpl | gpl (?:version |v )?2(?: 0)?
gpl-3.0 | 80 | gpl | gpl (?:version |v )?3(?: 0)?
gpl-2.0 | 80 | gplv2 | gplv2
gpl-3.0 | 80 | gplv3 | gplv3
gpl | 70 | gnu | gnu general public license
gpl | 60 | gnu | gnu gpl
gpl | 55 | gpl | (?:licensed|released|distributed) under (?:the )?gpl
gpl | 50 | copying | you should have received a copy of the gnu general public license .{0,60}?copying
gpl | 75 | gnu | www gnu org licenses gpl
gpl-2.0 | 82 | gnu | www gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | 82 | gnu | www gnu org licenses gpl 3 0
gpl-classpath-exception | 88 | classpath | classpath exception
gpl-classpath-exception | 88 | exception | as a special exception .{0,200}?link this library with independent modules
gcc-exception | 88 | gcc | gcc runtime library exception
lgpl | 96 | lesser | under the terms of the gnu lesser general public license
lgpl-2.0 | 92 | library | gnu library general public license
lgpl-2.1 | 90 | lesser | gnu lesser general public license (?:version |v )?2 1
lgpl-3.0 | 90 | lesser | gnu lesser general public license (?:version |v )?3(?: 0)?
lgpl | 80 | lesser | (?:gnu )?lesser general public license
lgpl-2.1 | 80 | lgpl | lgpl (?:version |v )?2 1
lgpl-3.0 | 80 | lgpl | lgpl (?:version |v )?3(?: 0)?
lgpl-2.1 | 80 | lgplv2 | lgplv2 1
lgpl-3.0 | 80 | lgplv3 | lgplv3
lgpl | 60 | lgpl | (?:gnu )?lgpl
lgpl | 76 | gnu | www gnu org licenses lgpl
agpl | 96 | affero | under the terms of the gnu affero general public license
agpl-3.0 | 90 | affero | gnu affero general public license (?:version |v )?3(?: 0)?
agpl-1.0 | 90 | affero | affero general public license (?:version |v )?1
agpl | 80 | affero | (?:gnu )?affero general public license
agpl-3.0 | 80 | agpl | agpl (?:version |v )?3(?: 0)?
agpl-3.0 | 80 | agplv3 | agplv3
agpl | 60 | agpl | (?:gnu )?agpl
agpl | 76 | gnu | www gnu org licenses agpl
gfdl | 88 | gnu | gnu free documentation license
gfdl-1.3 | 90 | gnu | gnu free documentation license (?:version |v )?1 3
gfdl-1.2 | 90 | gnu | gnu free documentation license (?:version |v )?1 2
gfdl | 60 | gfdl | gfdl
mpl-2.0 | 95 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 95 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | 85 | mozilla | mozilla public license (?:version |v )?2(?: 0)?
mpl-1.1 | 85 | mozilla | mozilla public license (?:version |v )?1 1
mpl-1.0 | 85 | mozilla | mozilla public license (?:version |v )?1 0
mpl-2.0 | 80 | mpl | mozilla org mpl 2 0
mpl-2.0 | 75 | mpl | mpl (?:version |v )?2 0
mpl | 60 | mozilla | mozilla public license
epl-2.0 | 85 | eclipse | eclipse public license (?:version |v )?2(?: 0)?
epl-1.0 | 85 | eclipse | eclipse public license (?:version |v )?1 0
epl-2.0 | 82 | eclipse | eclipse org legal epl (?:2 0|v20)
epl-1.0 | 82 | eclipse | eclipse org legal epl v10
edl-1.0 | 85 | eclipse | eclipse distribution license (?:version |v )?1 0
epl | 60 | eclipse | eclipse public license
cpl-1.0 | 80 | common | common public license (?:version |v )?1 0
cpal-1.0 | 80 | attribution | common public attribution license
cddl-1.0 | 85 | cddl | (?:common development and distribution license .{0,20}?)?cddl (?:version |v )?1 0
cddl | 75 | common | common development and distribution license
ipl-1.0 | 75 | ibm | ibm public license
bsl-1.0 | 95 | boost | distributed under the boost software license version 1 0
bsl-1.0 | 80 | boost | boost software license
zlib | 95 | altered | altered source versions must be plainly marked as such and must not be misrepresented
zlib | 90 | misrepresented | the origin of this software must not be misrepresented
zlib | 75 | zlib | zlib (?:libpng )?license
libpng | 75 | libpng | libpng license
unlicense | 95 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 80 | unlicense | (?:the unlicense|unlicense org)
wtfpl | 90 | fuck | do what the fuck you want to public license
wtfpl | 80 | wtfpl | wtfpl
artistic-2.0 | 85 | artistic | artistic license (?:version |v )?2 0
artistic-1.0 | 85 | artistic | artistic license (?:version |v )?1 0
artistic | 70 | artistic | artistic license
perl | 75 | perl | under the same terms as perl itself
python-2.0 | 85 | python | python software foundation license
python-2.0 | 75 | psf | psf license
ruby | 75 | ruby | ruby license
php-3.01 | 85 | php | php license (?:version |v )?3 01
php | 70 | php | php license
postgresql | 85 | postgresql | postgresql license
openssl | 85 | openssl | openssl (?:and ssleay )?license
ssleay | 80 | ssleay | ssleay license
ncsa | 85 | ncsa | (?:university of illinois )?ncsa open source license
w3c | 85 | w3c | w3c software (?:notice and )?license
unicode | 85 | unicode | unicode (?:inc )?license agreement
icu | 80 | icu | icu license
curl | 75 | curl | curl license
vim | 75 | vim | vim license
tcl | 75 | tcl | tcl tk license
beerware | 85 | beer | (?:the )?beer ware license
beerware | 85 | beerware | (?:the )?beerware license
json | 90 | evil | the software shall be used for good not evil
sleepycat | 80 | sleepycat | sleepycat license
eupl-1.2 | 85 | european | european union public licen[cs]e (?:version |v )?1 2
eupl-1.1 | 85 | european | european union public licen[cs]e (?:version |v )?1 1
eupl | 70 | european | european union public licen[cs]e
eupl | 60 | eupl | eupl
cecill-2.1 | 80 | cecill | cecill (?:free software license agreement )?(?:version |v )?2 1
cecill | 65 | cecill | cecill
ms-pl | 80 | microsoft | microsoft public license
ms-rl | 80 | microsoft | microsoft reciprocal license
apsl-2.0 | 80 | apple | apple public source license
osl-3.0 | 80 | open | open software license (?:version |v )?3 0
afl-3.0 | 80 | academic | academic free license (?:version |v )?3 0
afl | 70 | academic | academic free license
lppl-1.3c | 80 | latex | latex project public license
ofl-1.1 | 85 | sil | sil open font license (?:version |v )?1 1
ofl | 75 | font | open font license
blueoak-1.0.0 | 80 | blue | blue oak model license
mulanpsl-2.0 | 80 | mulan | mulan permissive software license
upl-1.0 | 80 | universal | universal permissive license
sspl-1.0 | 85 | server | server side public license
busl-1.1 | 85 | business | business source license
elastic-2.0 | 85 | elastic | elastic license (?:version |v )?2(?: 0)?
commons-clause | 85 | commons | commons clause
cc0-1.0 | 90 | waived | has waived all copyright and related or neighboring rights
cc0-1.0 | 85 | cc0 | cc0 (?:1 0|universal)
cc0-1.0 | 82 | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | 60 | cc0 | cc0
cc-by-4.0 | 88 | creative | creative commons attribution 4 0
cc-by-3.0 | 88 | creative | creative commons attribution 3 0
cc-by-sa-4.0 | 88 | creative | creative commons attribution share ?alike 4 0
cc-by-sa-3.0 | 88 | creative | creative commons attribution share ?alike 3 0
cc-by-nc-4.0 | 88 | creative | creative commons attribution non ?commercial 4 0
cc-by-nc-sa-4.0 | 88 | creative | creative commons attribution non ?commercial share ?alike 4 0
cc-by-nc-nd-4.0 | 88 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0
cc-by-nd-4.0 | 88 | creative | creative commons attribution no ?deriv(?:ative)?s 4 0
cc-by-4.0 | 86 | creativecommons | creativecommons org licenses by 4 0
cc-by-3.0 | 86 | creativecommons | creativecommons org licenses by 3 0
cc-by-sa-4.0 | 86 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 86 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | 86 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | 86 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | 86 | creativecommons | creativecommons org licenses by nc nd 4 0
cc-by-nd-4.0 | 86 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-4.0 | 80 | cc | cc by 4 0
cc-by-3.0 | 80 | cc | cc by 3 0
cc-by-2.0 | 80 | cc | cc by 2 0
cc-by-sa-4.0 | 80 | cc | cc by sa 4 0
cc-by-sa-3.0 | 80 | cc | cc by sa 3 0
cc-by-nc-4.0 | 80 | cc | cc by nc 4 0
cc-by-nc-sa-4.0 | 80 | cc | cc by nc sa 4 0
cc-by-nc-nd-4.0 | 80 | cc | cc by nc nd 4 0
cc-by-nd-4.0 | 80 | cc | cc by nd 4 0
cc-by-sa | 65 | cc | cc by sa
cc-by-nc | 65 | cc | cc by nc
cc-by-nd | 65 | cc | cc by nd
cc-by | 60 | cc | cc by
cc | 50 | creative | creative commons
odbl-1.0 | 85 | database | open (?:data commons open )?database license
odc-by-1.0 | 85 | commons | open data commons attribution license
pddl-1.0 | 85 | public | (?:open data commons )?public domain dedication and licen[cs]e
public-domain | 80 | public | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 60 | public | (?:this (?:file|software|work|code) is )(?:in )?(?:the )?public domain
proprietary | 75 | rights | all rights reserved
proprietary | 80 | proprietary | proprietary and confidential
proprietary | 70 | unauthorized | unauthorized (?:copying|use|reproduction|distribution) .{0,60}?(?:strictly )?prohibited
no-warranty | 40 | warranty | without warranty of any kind
no-warranty | 40 | warranties | without warranties or conditions of any kind
no-warranty | 40 | warranty | without any warranty
"""
