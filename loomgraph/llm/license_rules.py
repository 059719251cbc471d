"""Signature rules for licence texts, over words in lower case with one space between them.

A rule is (label, priority, keyword, pattern): smaller priorities win, the pattern runs only over texts that contain the
keyword, and matches whole words.  Families that differ by version or variant are spelled out by rule, not by hand.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


#: Priorities: an SPDX identifier, a text of the licence itself, a notice or reference, a mere mention.
IDENTIFIER, BODY, NOTICE, MENTION = 1, 2, 3, 4
CONFIDENCE = {IDENTIFIER: 1.0, BODY: 0.95, NOTICE: 0.9, MENTION: 0.6}

#: Phrases that always count, with their labels (fixed values).
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_V = r"(?:v|ver |version )?"
_OR_LATER = r"(?: only| or later| or any later version| or at your option any later version)?"

_TEXTS = (
    ("mit", BODY, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", BODY, "permission notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", NOTICE, "licen", r"(?:released|licensed|distributed|available|published) under the (?:terms of the )?mit licen[sc]e"),
    ("mit", NOTICE, "licen", r"mit style licen[sc]e"),
    ("mit", NOTICE, "licen", r"the mit licen[sc]e mit"),
    ("mit", NOTICE, "expat", r"expat licen[sc]e"),
    ("mit-0", NOTICE, "no attribution", r"mit no attribution(?: licen[sc]e)?"),
    ("x11", NOTICE, "x11", r"x11 licen[sc]e"),
    ("x11", BODY, "consortium", r"except as contained in this notice the name of the x consortium shall not be used"),
    ("isc", BODY, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", NOTICE, "isc licen", r"(?:the )?isc licen[sc]e"),
    ("0bsd", NOTICE, "bsd", r"(?:zero clause bsd|bsd zero clause|bsd 0 clause|0bsd)(?: licen[sc]e)?"),
    ("bsd-2-clause", NOTICE, "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[sc]e"),
    ("bsd-2-clause", NOTICE, "bsd", r"bsd 2 clause(?: simplified)?(?: licen[sc]e)?"),
    ("bsd-3-clause", NOTICE, "bsd", r"(?:new|revised|modified|3 clause|three clause) bsd licen[sc]e"),
    ("bsd-3-clause", NOTICE, "bsd", r"bsd 3 clause(?: new| revised| clear)?(?: licen[sc]e)?"),
    ("bsd-3-clause", BODY, "endorse or promote", r"neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", BODY, "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-4-clause", NOTICE, "bsd", r"(?:original|old|4 clause|four clause) bsd licen[sc]e"),
    ("bsd", BODY, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", NOTICE, "bsd", r"(?:a |the )?bsd (?:style )?licen[sc]e"),
    ("bsd", MENTION, "berkeley", r"berkeley software distribution licen[sc]e"),
    ("apache-2.0", BODY, "apache", r"licensed under the apache licen[sc]e version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", NOTICE, "apache", rf"apache (?:software )?licen[sc]e {_V}2(?: 0)?"),
    ("apache-2.0", NOTICE, "apache", r"www apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", MENTION, "apache", r"apache (?:v)?2(?: 0)? licen[sc]e"),
    ("apache-1.1", NOTICE, "apache", rf"apache (?:software )?licen[sc]e {_V}1 1"),
    ("apache-1.0", NOTICE, "apache", rf"apache (?:software )?licen[sc]e {_V}1 0"),
    ("apache", MENTION, "apache", r"(?:under|with) (?:the )?apache licen[sc]e"),
    ("gpl", NOTICE, "gpl", r"licen[sc]ed under (?:the )?(?:gnu )?gpl"),
    ("gpl", NOTICE, "gnu", r"gnu general public licen[sc]e as published by the free software foundation"),
    ("gpl", BODY, "free software", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", BODY, "without any warranty", r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl", MENTION, "gnu", r"gnu gpl"),
    ("gpl", NOTICE, "gnu", r"you should have received a copy of the gnu general public licen[sc]e"),
    ("gpl-classpath-exception", NOTICE, "classpath", r"(?:gnu )?classpath exception"),
    ("gpl-linking-exception", NOTICE, "linking", r"linking this (?:library|software) statically or dynamically with other modules"),
    ("lgpl", NOTICE, "gnu", r"gnu (?:lesser|library) general public licen[sc]e"),
    ("lgpl", BODY, "free software", r"this library is free software you can redistribute it and or modify it"),
    ("agpl", NOTICE, "gnu", r"gnu affero general public licen[sc]e"),
    ("agpl", MENTION, "affero", r"affero general public licen[sc]e"),
    ("gfdl", NOTICE, "gnu", r"gnu free documentation licen[sc]e"),
    ("gfdl", BODY, "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-1.0", NOTICE, "mozilla", rf"mozilla public licen[sc]e {_V}1 0"),
    ("mpl-1.1", NOTICE, "mozilla", rf"mozilla public licen[sc]e {_V}1 1"),
    ("mpl-2.0", NOTICE, "mozilla", rf"mozilla public licen[sc]e {_V}2 0"),
    ("mpl-2.0", BODY, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("mpl", MENTION, "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", NOTICE, "eclipse", rf"eclipse public licen[sc]e {_V}1 0"),
    ("epl-2.0", NOTICE, "eclipse", rf"eclipse public licen[sc]e {_V}2 0"),
    ("epl", MENTION, "eclipse", r"eclipse public licen[sc]e"),
    ("edl-1.0", NOTICE, "eclipse", rf"eclipse distribution licen[sc]e(?: {_V}1 0)?"),
    ("cddl-1.0", NOTICE, "development and distribution", rf"common development and distribution licen[sc]e(?: cddl)?(?: {_V}1 0)?"),
    ("cddl-1.1", NOTICE, "development and distribution", rf"common development and distribution licen[sc]e(?: cddl)? {_V}1 1"),
    ("cpl-1.0", NOTICE, "common public", rf"common public licen[sc]e(?: {_V}1 0)?"),
    ("ipl-1.0", NOTICE, "ibm", rf"ibm public licen[sc]e(?: {_V}1 0)?"),
    ("eupl-1.1", NOTICE, "european union", rf"european union public licen[sc]e {_V}1 1"),
    ("eupl-1.2", NOTICE, "european union", rf"european union public licen[sc]e {_V}1 2"),
    ("eupl", MENTION, "european union", r"european union public licen[sc]e"),
    ("cecill-2.1", NOTICE, "cecill", rf"cecill (?:free software )?licen[sc]e(?: agreement)? {_V}2 1"),
    ("cecill-b", NOTICE, "cecill", r"cecill b(?: licen[sc]e)?"),
    ("cecill-c", NOTICE, "cecill", r"cecill c(?: licen[sc]e)?"),
    ("cecill", MENTION, "cecill", r"cecill (?:free software )?licen[sc]e"),
    ("osl-3.0", NOTICE, "open software", rf"open software licen[sc]e(?: {_V}3 0)?"),
    ("afl-3.0", NOTICE, "academic free", rf"academic free licen[sc]e(?: {_V}3 0)?"),
    ("artistic-1.0", NOTICE, "artistic", rf"artistic licen[sc]e(?: {_V}1 0)?"),
    ("artistic-2.0", NOTICE, "artistic", rf"artistic licen[sc]e {_V}2 0"),
    ("perl", NOTICE, "perl", r"under the same terms as perl itself"),
    ("zlib", NOTICE, "zlib", r"zlib (?:libpng )?licen[sc]e"),
    ("zlib", BODY, "as is without any express", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("libpng", NOTICE, "libpng", r"libpng licen[sc]e"),
    ("bsl-1.0", NOTICE, "boost", rf"boost software licen[sc]e(?: {_V}1 0)?"),
    ("busl-1.1", NOTICE, "business source", rf"business source licen[sc]e(?: {_V}1 1)?"),
    ("sspl-1.0", NOTICE, "server side", rf"server side public licen[sc]e(?: {_V}1)?"),
    ("elastic-2.0", NOTICE, "elastic", rf"elastic licen[sc]e(?: {_V}2(?: 0)?)?"),
    ("commons-clause", NOTICE, "commons clause", r"commons clause(?: licen[sc]e)?(?: condition)?"),
    ("polyform-noncommercial", NOTICE, "polyform", r"polyform noncommercial licen[sc]e"),
    ("polyform-small-business", NOTICE, "polyform", r"polyform small business licen[sc]e"),
    ("unlicense", NOTICE, "unlicense", r"(?:the )?unlicense"),
    ("unlicense", BODY, "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", NOTICE, "public domain", r"(?:released|placed|dedicated) (?:into|in|to) the public domain"),
    ("public-domain", MENTION, "public domain", r"(?:is|are) (?:in the )?public domain"),
    ("wtfpl", NOTICE, "wtfpl", r"wtfpl(?: licen[sc]e)?"),
    ("beerware", NOTICE, "beer", r"beer ?ware licen[sc]e"),
    ("psf-2.0", NOTICE, "python software", rf"python software foundation licen[sc]e(?: {_V}2)?"),
    ("php-3.01", NOTICE, "php licen", rf"php licen[sc]e(?: {_V}3 01)?"),
    ("ruby", NOTICE, "ruby licen", r"ruby licen[sc]e"),
    ("openssl", NOTICE, "openssl", r"openssl licen[sc]e"),
    ("ssleay", NOTICE, "ssleay", r"original ssleay licen[sc]e"),
    ("curl", NOTICE, "curl licen", r"curl licen[sc]e"),
    ("ncsa", NOTICE, "ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e"),
    ("w3c", NOTICE, "w3c", r"w3c software (?:notice and )?licen[sc]e"),
    ("ofl-1.1", NOTICE, "open font", rf"(?:sil )?open font licen[sc]e(?: {_V}1 1)?"),
    ("upl-1.0", NOTICE, "universal permissive", rf"universal permissive licen[sc]e(?: {_V}1 0)?"),
    ("ms-pl", NOTICE, "microsoft public", r"microsoft public licen[sc]e"),
    ("ms-rl", NOTICE, "microsoft reciprocal", r"microsoft reciprocal licen[sc]e"),
    ("apsl-2.0", NOTICE, "apple public", rf"apple public source licen[sc]e(?: {_V}2 0)?"),
    ("qpl-1.0", NOTICE, "q public", rf"q public licen[sc]e(?: {_V}1 0)?"),
    ("sleepycat", NOTICE, "sleepycat", r"sleepycat licen[sc]e"),
    ("vim", NOTICE, "vim licen", r"vim licen[sc]e"),
    ("postgresql", NOTICE, "postgresql", r"postgresql licen[sc]e"),
    ("blueoak-1.0.0", NOTICE, "blue oak", rf"blue oak model licen[sc]e(?: {_V}1 0 0)?"),
    ("mulan-psl-2", NOTICE, "mulan", rf"mulan (?:permissive software licen[sc]e|psl)(?: {_V}2)?"),
    ("odbl-1.0", NOTICE, "database licen", rf"open (?:data commons )?(?:open )?database licen[sc]e(?: {_V}1 0)?"),
    ("odc-by-1.0", NOTICE, "open data commons", rf"open data commons attribution licen[sc]e(?: {_V}1 0)?"),
    ("pddl-1.0", NOTICE, "public domain", rf"(?:open data commons )?public domain dedication and licen[sc]e(?: {_V}1 0)?"),
    ("ogl-3.0", NOTICE, "open government", rf"open government licen[sc]e(?: {_V}3 0)?"),
    ("cc0-1.0", NOTICE, "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    ("cc0-1.0", BODY, "waived all copyright", r"waived all copyright and related or neighboring rights"),
    ("openrail", NOTICE, "rail", r"(?:creativeml |bigscience |bigcode )?open ?rail(?: m| s)?(?: licen[sc]e)?"),
    ("llama-community", NOTICE, "community licen", r"llama (?:\d )?(?:\d )?community licen[sc]e(?: agreement)?"),
    ("proprietary", NOTICE, "all rights reserved", r"all rights reserved"),
    ("proprietary", NOTICE, "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("copyright", MENTION, "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
)

#: Sentences of licence bodies (fixed values): what remains of a licence where its name has been cut off.
_BODIES = (
    ("gpl-2.0", BODY, "freedom to share", r"the licen[sc]es for most software are designed to take away your freedom to share and change it by contrast the gnu general public licen[sc]e"),
    ("gpl-2.0", BODY, "work based on the program", r"the program below refers to any such program or work and a work based on the program means either the program or any derivative work"),
    ("gpl-2.0", BODY, "verbatim copies", r"you may copy and distribute verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl-2.0", BODY, "modify your copy", r"you may modify your copy or copies of the program or any portion of it thus forming a work based on the program"),
    ("gpl-2.0", BODY, "not signed it", r"you are not required to accept this licen[sc]e since you have not signed it"),
    ("gpl-2.0", BODY, "cause any work", r"you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program"),
    ("gpl-2.0", BODY, "mere aggregation", r"mere aggregation of another work not based on the program with the program"),
    ("gpl-3.0", BODY, "practical works", r"the licen[sc]es for most software and other practical works are designed to take away your freedom to share and change the works"),
    ("gpl-3.0", BODY, "convey", r"to convey a work means any kind of propagation that enables other parties to make or receive copies"),
    ("gpl-3.0", BODY, "propagate", r"to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gpl-3.0", BODY, "installation information", r"installation information for a user product means any methods procedures authorization keys or other information required"),
    ("gpl-3.0", BODY, "covered work", r"you may convey a covered work in object code form under the terms of sections 4 and 5"),
    ("gpl-3.0", BODY, "technological measure", r"no covered work shall be deemed part of an effective technological measure under any applicable law"),
    ("gpl-3.0", BODY, "discriminatory", r"a patent licen[sc]e is discriminatory if it does not include within the scope of its coverage"),
    ("gpl-3.0", BODY, "corresponding source", r"the corresponding source for a work in object code form means all the source code needed to generate"),
    ("lgpl-2.1", BODY, "specially designated", r"this licen[sc]e the lesser general public licen[sc]e applies to some specially designated software packages typically libraries"),
    ("lgpl-2.1", BODY, "derivative of any portion", r"a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("lgpl-2.1", BODY, "reverse engineering", r"provided that the terms permit modification of the work for the customer s own use and reverse engineering for debugging such modifications"),
    ("lgpl-2.1", BODY, "prominent notice", r"you must give prominent notice with each copy of the work that the library is used in it"),
    ("lgpl-3.0", BODY, "lesser general public", r"this version of the gnu lesser general public licen[sc]e incorporates the terms and conditions of version 3 of the gnu general public licen[sc]e"),
    ("lgpl-3.0", BODY, "combined work", r"a combined work is a work produced by combining or linking an application with the library"),
    ("lgpl-3.0", BODY, "linked version", r"the particular version of the library with which the combined work was made is also called the linked version"),
    ("agpl-3.0", BODY, "affero", r"the gnu affero general public licen[sc]e is designed specifically to ensure that in such cases the modified source code becomes available to the community"),
    ("agpl-3.0", BODY, "remotely through a computer network", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl-1.3", BODY, "secondary section", r"a secondary section is a named appendix or a front matter section of the document"),
    ("gfdl-1.3", BODY, "massive multiauthor", r"massive multiauthor collaboration site or mmc site means any world wide web server"),
    ("gfdl-1.3", BODY, "copyleft", r"this licen[sc]e is a kind of copyleft which means that derivative works of the document must themselves be free in the same sense"),
    ("apache-2.0", BODY, "licensor", r"licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the licen[sc]e"),
    ("apache-2.0", BODY, "legal entity", r"legal entity shall mean the union of the acting entity and all other entities that control are controlled by or are under common control with that entity"),
    ("apache-2.0", BODY, "contributor hereby grants", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[sc]e"),
    ("apache-2.0", BODY, "contributor hereby grants", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent licen[sc]e"),
    ("apache-2.0", BODY, "unless required by applicable law", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", BODY, "notice text file", r"if the work includes a notice text file as part of its distribution"),
    ("apache-2.0", BODY, "trademarks", r"this licen[sc]e does not grant permission to use the trade names trademarks service marks or product names of the licensor"),
    ("apache-1.1", BODY, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("mit", BODY, "as is without warranty", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", BODY, "authors or copyright holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit", BODY, "deal in the software", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[sc]e and or sell copies"),
    ("isc", BODY, "disclaims all warranties", r"the software is provided as is and (?:the author|isc|\S+ \S+) disclaims all warranties with regard to this software"),
    ("hpnd", BODY, "without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("bsd", BODY, "retain the above copyright", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", BODY, "reproduce the above copyright", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", BODY, "copyright holders and contributors", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd-3-clause-clear", BODY, "express or implied licen", r"no express or implied licen[sc]es to any party s patent rights are granted by this licen[sc]e"),
    ("bsd-3-clause-no-nuclear", BODY, "nuclear facility", r"this software is not designed licen[sc]ed or intended for use in the design construction operation or maintenance of any nuclear facility"),
    ("bsd-2-clause-patent", BODY, "each copyright holder and contributor", r"subject to the terms and conditions of this licen[sc]e each copyright holder and contributor hereby grants"),
    ("mpl-2.0", BODY, "incompatible with secondary", r"this source code form is incompatible with secondary licen[sc]es as defined by the mozilla public licen[sc]e"),
    ("mpl-2.0", BODY, "larger work", r"larger work means a work that combines covered software with other material in a separate file or files that is not covered software"),
    ("mpl-2.0", BODY, "covered software", r"all distribution of covered software in source code form including any modifications that you create"),
    ("mpl-2.0", BODY, "contributor version", r"contributor version means the combination of the contributions of others if any used by a contributor"),
    ("mpl-1.1", BODY, "covered code", r"covered code means the original code or modifications or the combination of the original code and modifications"),
    ("mpl-1.1", BODY, "initial developer", r"the initial developer hereby grants you a world wide royalty free non exclusive licen[sc]e subject to third party intellectual property claims"),
    ("epl-1.0", BODY, "constitutes recipient", r"the accompanying program is provided under the terms of this eclipse public licen[sc]e agreement any use reproduction or distribution of the program constitutes recipient s acceptance"),
    ("epl-1.0", BODY, "commercial contributor", r"if a contributor includes the program in a commercial product offering such contributor commercial contributor hereby agrees to defend and indemnify"),
    ("epl-2.0", BODY, "secondary licen", r"this source code may also be made available under the following secondary licen[sc]es when the conditions"),
    ("epl-2.0", BODY, "modified works", r"modified works shall mean any work in source code or other form that results from an addition to deletion from or modification of the contents of the program"),
    ("cddl-1.0", BODY, "covered software", r"covered software means a the original software or b modifications or c the combination of files containing original software"),
    ("cddl-1.0", BODY, "executable form", r"you may distribute the executable form of the covered software under the terms of this licen[sc]e or under the terms of a licen[sc]e of your choice"),
    ("cpl-1.0", BODY, "common public licen", r"the accompanying program is provided under the terms of this common public licen[sc]e agreement"),
    ("eupl-1.2", NOTICE, "eupl", r"licen[sc]ed under the eupl(?: v 1 2| version 1 2)?"),
    ("eupl-1.2", BODY, "eupl", r"this european union public licen[sc]e the eupl applies to the work as defined below which is provided under the terms of this licen[sc]e"),
    ("eupl-1.2", BODY, "compatibility clause", r"compatibility clause if the licensee distributes or communicates derivative works or copies thereof based upon both the work and another work"),
    ("cecill-2.1", BODY, "cecill", r"this software is governed by the cecill licen[sc]e under french law and abiding by the rules of distribution of free software"),
    ("osl-3.0", BODY, "external deployment", r"external deployment means the use distribution or communication of the original work or derivative works in any way"),
    ("osl-3.0", BODY, "open software", r"licen[sc]ed under the open software licen[sc]e version 3 0"),
    ("afl-3.0", BODY, "academic free", r"licen[sc]ed under the academic free licen[sc]e version 3 0"),
    ("artistic-1.0", BODY, "artistic control", r"the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2.0", BODY, "given free software package", r"this licen[sc]e establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("artistic-2.0", BODY, "modified version", r"you may distribute your modified version as source either gratis or for a distributor fee"),
    ("zlib", BODY, "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", BODY, "origin of this software", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("bsl-1.0", BODY, "person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    ("bsl-1.0", BODY, "machine executable", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("busl-1.1", BODY, "non production use", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licen[sc]ed work"),
    ("busl-1.1", BODY, "change date", r"effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl-1.0", BODY, "service source code", r"service source code means the corresponding source for the program or the modified version and the corresponding source for all programs that you use to make the program"),
    ("elastic-2.0", BODY, "hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", BODY, "right to sell the software", r"the grant of rights under the licen[sc]e will not include and the licen[sc]e does not grant to you the right to sell the software"),
    ("polyform-noncommercial", BODY, "noncommercial purpose", r"any noncommercial purpose is a permitted purpose"),
    ("polyform-shield", BODY, "competes with", r"any purpose is a permitted purpose except for providing any product that competes with the software"),
    ("prosperity", BODY, "prosperity", r"the prosperity public licen[sc]e"),
    ("parity", BODY, "parity public", r"the parity public licen[sc]e"),
    ("unlicense", BODY, "free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("unlicense", BODY, "dedication", r"we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("wtfpl", BODY, "do what the", r"do what the f\S+ you want to(?: public licen[sc]e)?"),
    ("beerware", BODY, "buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("ofl-1.1", BODY, "font software", r"the font software may be modified altered or added to and in particular the designs of glyphs or characters"),
    ("ofl-1.1", BODY, "reserved font name", r"reserved font name refers to any names specified as such after the copyright statement"),
    ("ofl-1.1", BODY, "sold by itself", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("ubuntu-font-1.0", NOTICE, "ubuntu font", r"ubuntu font licen[sc]e(?: version 1 0| 1 0)?"),
    ("ms-pl", BODY, "reproduction", r"the terms reproduce reproduction derivative works and distribution have the same meaning here as under u s copyright law"),
    ("apsl-2.0", BODY, "externally deploy", r"externally deploy means a to sublicen[sc]e distribute or otherwise make covered code available directly or indirectly to anyone other than you"),
    ("psf-2.0", BODY, "python software foundation", r"this licen[sc]e agreement is between the python software foundation psf and the individual or organization"),
    ("cnri-python", BODY, "corporation for national research", r"this licen[sc]e agreement is between the corporation for national research initiatives"),
    ("php-3.01", BODY, "php software", r"this product includes php software freely available from"),
    ("ruby", BODY, "place your modifications", r"place your modifications in the public domain or otherwise make them freely available such as by posting said modifications to usenet"),
    ("openssl", BODY, "openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", BODY, "eric young", r"this product includes cryptographic software written by eric young"),
    ("ncsa", BODY, "deal with the software", r"to deal with the software without restriction including without limitation the rights to use"),
    ("postgresql", BODY, "without a written agreement", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("json", BODY, "good not evil", r"the software shall be used for good not evil"),
    ("ijg", BODY, "independent jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("ftl", BODY, "freetype", r"portions of this software are copyright (?:\S+ ){0,3}?the freetype project"),
    ("unicode", BODY, "unicode inc", r"unicode inc licen[sc]e agreement data files and software"),
    ("info-zip", NOTICE, "info zip", r"info zip licen[sc]e"),
    ("naist", BODY, "nara institute", r"nara institute of science and technology naist"),
    ("cc0-1.0", BODY, "affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("cc-by", BODY, "appropriate credit", r"you must give appropriate credit provide a link to the licen[sc]e and indicate if changes were made"),
    ("cc-by-sa", BODY, "same licen", r"you must distribute your contributions under the same licen[sc]e as the original"),
    ("cc-by-nc", BODY, "commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-nd", BODY, "modified material", r"you may not distribute the modified material"),
    ("creative-commons", BODY, "adapted material", r"adapted material means material subject to copyright and similar rights that is derived from or based upon the licen[sc]ed material"),
    ("creative-commons", BODY, "collection", r"a work that constitutes a collection will not be considered an adaptation"),
    ("creative-commons", BODY, "not a law firm", r"creative commons (?:corporation )?is not a law firm and does not provide legal services"),
    ("odbl-1.0", BODY, "derivative database", r"derivative database means a database based upon the database"),
    ("odbl-1.0", BODY, "produced work", r"produced work means a work such as an image audiovisual material text or sounds"),
    ("cdla-permissive-2.0", NOTICE, "community data", r"community data licen[sc]e agreement permissive(?: version)?(?: 2 0| 1 0)?"),
    ("cdla-sharing-1.0", NOTICE, "community data", r"community data licen[sc]e agreement sharing(?: version)?(?: 1 0)?"),
    ("ogl-3.0", BODY, "public sector information", r"contains public sector information licen[sc]ed under the open government licen[sc]e"),
    ("etalab-2.0", NOTICE, "etalab", r"etalab open licen[sc]e(?: 2 0)?"),
    ("etalab-2.0", NOTICE, "licence ouverte", r"licence ouverte(?: etalab)?(?: 2 0)?"),
    ("proprietary", BODY, "may be reproduced", r"no part of this (?:publication|work|software|document) may be reproduced"),
    ("openrail", BODY, "use based restrictions", r"use based restrictions as referenced in (?:paragraph 5|attachment a)"),
    ("bigscience-rail-1.0", NOTICE, "bigscience", r"bigscience rail licen[sc]e(?: v1 0| 1 0)?"),
    ("llama-community", BODY, "llama materials", r"by (?:clicking i accept below or by )?using or distributing any portion or element of the llama materials"),
    ("llama-community", BODY, "monthly active users", r"greater than 700 million monthly active users in the preceding calendar month"),
    ("gemma", NOTICE, "gemma", r"gemma (?:terms of use|prohibited use policy)"),
    ("cc-by-nc", MENTION, "use only", r"(?:for )?non ?commercial use only"),
    ("research-only", NOTICE, "research purposes", r"(?:for|to) (?:academic |non ?commercial )?research purposes only"),
    ("hippocratic", NOTICE, "hippocratic", r"hippocratic licen[sc]e(?: version)?(?: 2 1| 3 0)?"),
    ("anti-996", NOTICE, "anti 996", r"anti 996 licen[sc]e(?: version)?(?: 1 0)?"),
    ("acsl", NOTICE, "anti capitalist", r"anti capitalist software licen[sc]e"),
    ("cpal-1.0", NOTICE, "common public attribution", r"common public attribution licen[sc]e(?: version)?(?: 1 0)?"),
    ("rpl-1.5", NOTICE, "reciprocal public", r"reciprocal public licen[sc]e(?: version)?(?: 1 5)?"),
    ("nposl-3.0", NOTICE, "non profit open", r"non profit open software licen[sc]e(?: version)?(?: 3 0)?"),
    ("lppl-1.3c", NOTICE, "latex project", r"latex project public licen[sc]e(?: version)?(?: 1 3c?)?"),
    ("ecl-2.0", NOTICE, "educational community", r"educational community licen[sc]e(?: version)?(?: 2 0)?"),
    ("proprietary", BODY, "written permission", r"may not be (?:copied|reproduced) (?:or distributed )?without (?:the )?(?:prior )?(?:express )?written permission"),
    ("proprietary", BODY, "trade secrets", r"contains (?:confidential|proprietary)(?: and (?:confidential|proprietary))? information and trade secrets"),
    ("eula", NOTICE, "end user licen", r"end user licen[sc]e agreement"),
)

#: SPDX identifiers as words (fixed values).
_SPDX = """
MIT MIT-0 ISC 0BSD BSD-2-Clause BSD-3-Clause BSD-4-Clause Apache-1.0 Apache-1.1 Apache-2.0 MPL-1.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0
CDDL-1.0 CDDL-1.1 EUPL-1.1 EUPL-1.2 CECILL-2.1 CECILL-B CECILL-C OSL-3.0 AFL-3.0 Artistic-1.0 Artistic-2.0 Zlib Libpng BSL-1.0
BUSL-1.1 SSPL-1.0 Elastic-2.0 Unlicense WTFPL Beerware PSF-2.0 PHP-3.01 Ruby OpenSSL curl NCSA W3C OFL-1.1 UPL-1.0 MS-PL MS-RL
APSL-2.0 QPL-1.0 Sleepycat Vim PostgreSQL BlueOak-1.0.0 MulanPSL-2.0 ODbL-1.0 ODC-By-1.0 PDDL-1.0 CC0-1.0 X11
""".split()


def _words(identifier: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in identifier.lower()).split())


def _identifiers() -> list[Rule]:
    return [Rule(x.lower(), IDENTIFIER, "spdx", f"spdx license identifier {_words(x)}") for x in _SPDX]


def _gnu() -> list[Rule]:
    out = []
    for short, long, versions in (("gpl", "general", ("1 0", "2 0", "3 0")), ("lgpl", "(?:lesser|library) general", ("2 0", "2 1", "3 0")), ("agpl", "affero general", ("1 0", "3 0"))):
        for v in versions:
            label = f"{short}-{v.replace(' ', '.')}"
            number = v if not v.endswith(" 0") else f"{v[0]}(?: 0)?"
            out += [
                Rule(label, IDENTIFIER, "spdx", f"spdx license identifier {short} {v}{_OR_LATER}"),
                Rule(label, NOTICE, "gnu", rf"gnu {long} public licen[sc]e(?: {short})? {_V}{number}{_OR_LATER}"),
                Rule(label, NOTICE, "gnu", rf"either version {number} of the licen[sc]e or at your option any later version (?:\S+ ){{0,40}}?gnu {long} public licen[sc]e"),
                Rule(label, MENTION, short, rf"{short} {_V}{number}{_OR_LATER}"),
                Rule(label, MENTION, short, rf"{short}v{number}{_OR_LATER}"),
                Rule(label, MENTION, short, rf"{short}{number}{_OR_LATER}"),
            ]
    return out


def _creative_commons() -> list[Rule]:
    names = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s(?: works)?"}
    out = []
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        spelled = " ".join(names[x] for x in kind.split())
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
            out += [
                Rule(label, IDENTIFIER, "spdx", f"spdx license identifier cc {kind} {version}"),
                Rule(label, NOTICE, "cc by", f"cc {kind} {version}"),
                Rule(label, NOTICE, "creative commons", rf"creative commons {spelled} {_V}{version}(?: (?:international|unported|generic))?(?: public)?(?: licen[sc]e)?"),
                Rule(label, NOTICE, "creativecommons", f"creativecommons org licenses {kind} {version}"),
            ]
        out.append(Rule(f"cc-{kind.replace(' ', '-')}", MENTION, "creative commons", f"creative commons {spelled}(?: licen[sc]e)?"))
        if kind != "by":
            out.append(Rule(f"cc-{kind.replace(' ', '-')}", MENTION, "cc by", f"cc {kind}"))
    return out


def rules() -> list[Rule]:
    return [*(Rule(*x) for x in (*_TEXTS, *_BODIES)), *_identifiers(), *_gnu(), *_creative_commons()]
