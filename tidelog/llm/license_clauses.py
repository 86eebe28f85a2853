"""Hand-written signatures of licence texts and notices, in word form.

Each is (label, tier, keyword, pattern, confidence), see ``license_rules``.  One line is one clause as it
stands in a licence's text, in its notice, or in what people write about it.
"""

from __future__ import annotations

TEXTS = [
    # MIT and relatives.
    ("mit", 1, "without restriction including", r"deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[cs]e and or sell", 0.97),
    ("mit", 1, "above copyright notice and this permission", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software", 0.97),
    ("mit", 1, "authors or copyright holders be liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", 0.9),
    ("mit", 2, "noninfringement in no event", r"fitness for a particular purpose and noninfringement in no event", 0.8),
    ("mit-0", 0, "furnished to do so the software is provided", r"to permit persons to whom the software is furnished to do so the software is provided as is", 0.85),
    ("mit-advertising", 0, "advertising materials", r"shall also be included in all advertising materials and documentation that permission is granted", 0.8),
    ("x11", 1, "x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising (?:or otherwise to promote the sale|licen[cs]e)", 0.97),
    ("x11", 1, "x window system", r"x window system is a (?:registered )?trademark (?:and copyright )?of the (?:x consortium|open group)", 0.7),
    ("mit-open-group", 1, "open group", r"except as contained in this notice the name of the open group shall not be used in advertising with permission", 0.9),
    ("hpnd", 0, "both that copyright notice", r"both that copyright notice and this permission notice appear in supporting documentation", 0.95),
    ("hpnd", 1, "used in advertising or publicity", r"not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission", 0.93),
    ("hpnd-sell", 1, "makes no representations about", r"makes no representations about the suitability of this software for any purpose it is provided as is without express or implied warranty", 0.9),
    ("cmu", 1, "carnegie mellon", r"carnegie mellon requests users of this software to return (?:to )?software distribution coordinator licen[cs]e|carnegie mellon allows free use of this software in its as is condition", 0.95),
    ("ntp", 0, "documentation for any purpose", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted", 0.95),
    ("isc", 1, "isc disclaims", r"isc disclaims all warranties with regard to this software", 0.95),
    ("isc", 1, "author disclaims all warranties", r"the software is provided as is and the author disclaims all warranties with regard to this software", 0.95),
    ("isc", 2, "tortious action", r"negligence or other tortious action arising out of or in connection with the use or performance of this software licen[cs]e|software is provided as is(?: .{1,200}?)? other tortious action", 0.8),
    ("0bsd", 0, "any purpose with or without fee", r"use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", 0.93),
    ("curl", 0, "curl", r"curl and libcurl are licen[cs]ed under (?:a )?(?:mit x derivate licen[cs]e|the licen[cs]e below)", 0.95),
    ("curl", 1, "name of a copyright holder", r"except as contained in this notice the name of a copyright holder shall not be used in advertising", 0.9),
    ("mit-feh", 1, "acknowledgment shall be given", r"acknowledgment shall be given in the documentation materials and software packages that this software was used", 0.85),
    ("json", 0, "good not evil", r"the software shall be used for good not evil", 0.99),
    ("json", 1, "json licen", r"(?:the )?json licen[cs]e", 0.85),
    ("bsd-mit-style", 2, "bsd mit", r"(?:dual )?bsd mit (?:style )?licen[cs]e", 0.7),
    ("blessing", 0, "legal notice here is a blessing", r"(?:in place of a )?legal notice here is a blessing may you do good and not evil|copyright to this source code in place of a legal notice here is a blessing", 0.99),
    ("beerware", 0, "buy me a beer", r"you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer(?: in return)?", 0.99),
    ("beerware", 1, "beerware", r"(?:the )?beerware licen[cs]e", 0.9),
    ("fair", 0, "usage of the works is permitted", r"usage of the works is permitted provided that this instrument is retained with the works", 0.99),
    ("wtfpl", 0, "you just do what", r"you just do what the (?:fuck|f) you want to", 0.98),
    ("wtfpl", 1, "everyone is permitted to copy", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document", 0.85),
    ("fsfap", 0, "without royalty provided", r"copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved", 0.99),
    ("fsful", 0, "unlimited permission to copy", r"gives unlimited permission to copy and or distribute it with or without modifications as long as this notice is preserved", 0.98),
    ("all-permissive", 1, "may be freely distributed", r"this (?:file|program|script|software) may be freely distributed (?:and modified )?provided (?:that )?this (?:copyright )?notice (?:is retained|remains intact) licen[cs]e|may be freely distributed as long as this copyright notice", 0.75),
    # BSD family.
    ("bsd-2-clause", 1, "source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 0.8),
    ("bsd-3-clause", 1, "names of its contributors", r"(?:neither the names? of(?: .{1,80}?)? nor|nor) the names of its contributors may be used to endorse or promote products", 0.93),
    ("bsd-3-clause", 1, "regents of the university", r"the regents of the university of california all rights reserved", 0.85),
    ("bsd-3-clause-clear", 0, "no express or implied licenses to any party", r"no express or implied licenses to any party s patent rights are granted by this licen[cs]e", 0.99),
    ("bsd-3-clause-lbnl", 0, "lawrence berkeley", r"lawrence berkeley national laboratory(?: .{1,200}?)? bug fixes patches or upgrades(?: .{1,200}?)? licen[cs]e|lawrence berkeley national laboratory all rights reserved", 0.9),
    ("bsd-3-clause-nuclear", 0, "nuclear facility", r"not designed licen[cs]ed or intended for use in the design construction operation or maintenance of any nuclear facility", 0.97),
    ("bsd-4-clause", 1, "must display the following", r"must display the following acknowledg(?:e)?ment this product includes software developed by", 0.96),
    ("bsd-4-clause-uc", 0, "university of california berkeley", r"this product includes software developed by the university of california berkeley and its contributors (?:copyright|redistributions)|copyright(?: .{1,60}?)? university of california berkeley", 0.85),
    ("bsd-2-clause-freebsd", 0, "freebsd project", r"official policies either expressed or implied of the freebsd project licen[cs]e|copyright(?: .{1,60}?)? the freebsd project", 0.9),
    ("bsd-2-clause-patent", 0, "plus patent", r"bsd (?:2 clause )?plus patent licen[cs]e", 0.95),
    ("bsd-source-code", 1, "redistributions of source code", r"redistributions of source code (?:only )?must retain the (?:above )?copyright notice (?:this list of conditions|and this list)", 0.75),
    ("bsd-protection", 0, "bsd protection", r"bsd protection licen[cs]e", 0.98),
    ("bsd-disclaimer", 3, "procurement of substitute goods", r"damages including but not limited to procurement of substitute goods or services licen[cs]e|in no event shall(?: .{1,120}?)? procurement of substitute goods or services", 0.5),
    ("bsd-disclaimer", 3, "copyright holders and contributors", r"this software is provided by the copyright holders and contributors as is", 0.55),
    ("sleepycat", 0, "how to obtain complete source code", r"redistributions in any form must be accompanied by information on how to obtain complete source code", 0.99),
    ("sleepycat", 1, "sleepycat", r"sleepycat (?:software )?(?:public )?licen[cs]e", 0.9),
    ("ncsa", 1, "deal with the software without restriction", r"permission(?: .{1,300}?)? deal with the software without restriction", 0.9),
    ("intel-bsd", 1, "export laws", r"you acknowledge that this software is not subject to restriction by the export laws licen[cs]e|export laws and regulations of the united states apply to this licen[cs]e", 0.6),
    ("mit-bsd-notice", 3, "bsd style licen", r"(?:use of this source code is governed by a|distributed under a) bsd style licen[cs]e that can be found in the licen[cs]e file", 0.9),
    # Apache.
    ("apache-2.0", 1, "asf under one or more", r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements", 0.98),
    ("apache-2.0", 1, "the notice file distributed", r"see the notice file distributed with this work for (?:additional )?information regarding copyright ownership", 0.9),
    ("apache-2.0", 1, "limitations under the license", r"see the licen[cs]e for the specific language governing permissions and limitations under the license", 0.9),
    ("apache-2.0", 1, "required by applicable law", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", 0.93),
    ("apache-2.0", 1, "terms and conditions for use", r"apache licen[cs]e(?: .{1,60}?)? terms and conditions for use reproduction and distribution", 0.98),
    ("apache-2.0", 2, "grant of patent", r"grant of patent licen[cs]e subject to the terms and conditions of this licen[cs]e", 0.7),
    ("apache-2.0", 2, "a readable copy", r"(?:include|contain) a readable copy of the attribution notices contained within such notice file", 0.85),
    ("apache-1.1", 0, "products derived from this software may not be called apache", r"products derived from this software may not be called apache nor may apache appear in their name", 0.98),
    ("apache-1.1", 1, "developed by the apache software foundation", r"this product includes software developed by the apache software foundation", 0.8),
    ("apache-1.0", 0, "apache group", r"this product includes software developed by the apache group for use in the apache http server project", 0.97),
    ("ecl-2.0", 1, "educational community", r"educational community licen[cs]e(?: .{1,40}?)? terms and conditions for use reproduction and distribution", 0.95),
    ("apache-llvm", 0, "llvm exceptions", r"apache licen[cs]e v ?2 0 with llvm exceptions", 0.99),
    ("apache-llvm", 0, "part of the llvm project", r"part of the llvm project under the apache licen[cs]e", 0.99),
    # GNU.
    ("gpl-family", 1, "redistribute it and or modify", r"free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 0.98),
    ("gpl-2.0-or-later", 0, "either version 2", r"free software foundation either version 2 of the licen[cs]e or at your option any later version", 0.98),
    ("gpl-3.0-or-later", 0, "either version 3", r"free software foundation either version 3 of the licen[cs]e or at your option any later version", 0.98),
    ("gpl-2.0-only", 0, "version 2 as", r"gnu general public licen[cs]e version 2 as published by the free software foundation", 0.97),
    ("gpl-3.0-only", 0, "version 3 as", r"gnu general public licen[cs]e version 3 as published by the free software foundation", 0.97),
    ("lgpl-2.1-or-later", 0, "either version 2 1", r"free software foundation either version 2 1 of the licen[cs]e or at your option any later version", 0.98),
    ("gpl-family", 2, "should have received a copy of the gnu", r"you should have received a copy of the gnu general public licen[cs]e along with this program", 0.93),
    ("lgpl", 2, "copy of the gnu lesser", r"you should have received a copy of the gnu lesser general public licen[cs]e along with this (?:library|program|software)", 0.95),
    ("lgpl-2.0", 2, "copy of the gnu library", r"you should have received a copy of the gnu library general public licen[cs]e along with this (?:library|program)", 0.95),
    ("agpl", 2, "copy of the gnu affero", r"you should have received a copy of the gnu affero general public licen[cs]e along with this program", 0.95),
    ("gpl-family", 3, "hope that it will be useful", r"distributed in the hope that it will be useful but without any warranty", 0.7),
    ("gpl-family", 2, "see the gnu general public", r"see the gnu general public licen[cs]e for more details", 0.85),
    ("lgpl", 2, "see the gnu lesser", r"see the gnu lesser general public licen[cs]e for more details", 0.87),
    ("gpl-family", 1, "freedom to share and change", r"the licen[cs]es for most software are designed to take away your freedom to share and change it", 0.98),
    ("gpl-3.0", 1, "free copyleft license", r"the gnu general public licen[cs]e is a free copyleft license for software and other kinds of works", 0.99),
    ("gpl-3.0", 1, "basic permissions", r"basic permissions all rights granted under this licen[cs]e are granted for the term of copyright on the program", 0.95),
    ("gpl-2.0", 1, "verbatim copies of the program", r"you may copy and distribute verbatim copies of the program s source code as you receive it(?: .{1,120}?)? copyright notice", 0.95),
    ("gpl-2.0", 1, "mere aggregation", r"mere aggregation of another work not based on the program with the program(?: .{1,120}?)? under the scope of this licen[cs]e", 0.95),
    ("agpl-3.0", 1, "remote network interaction", r"remote network interaction use with the gnu general public licen[cs]e", 0.98),
    ("agpl-3.0", 1, "interacting with it remotely", r"your modified version must prominently offer all users interacting with it remotely(?: .{1,200}?)? licen[cs]e|all users interacting with it remotely through a computer network(?: .{1,200}?)? corresponding source(?: .{1,100}?)? licen[cs]e", 0.93),
    ("lgpl", 1, "work that uses the library", r"a work that uses the library(?: .{1,120}?)? licen[cs]e", 0.75),
    ("lgpl-3.0", 1, "incorporates the terms and conditions", r"this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3", 0.99),
    ("gpl-linking-exception", 0, "special exception", r"as a special exception (?:to the gnu general public licen[cs]e|.{1,80}? gives? (?:you )?permission) (?:to|you may) (?:link|distribute|use|include)", 0.85),
    ("gpl-classpath", 0, "classpath", r"(?:designates this particular file as subject to the )?classpath exception (?:as provided|to the gnu|licen[cs]e)", 0.95),
    ("gpl-classpath", 1, "linking this library statically", r"linking this library statically or dynamically with other modules is making a combined work(?: .{1,120}?)? licen[cs]e", 0.9),
    ("gcc-exception", 0, "runtime library exception", r"gcc runtime library exception(?: version)? ?3? ?1?(?:(?: .{1,60}?)? licen[cs]e)|licen[cs]e with the gcc runtime library exception", 0.95),
    ("autoconf-exception", 1, "generated by autoconf", r"permission(?: .{1,120}?)? configuration script generated by autoconf", 0.9),
    ("bison-exception", 1, "bison parser skeleton", r"(?:under terms of your choice|permission)(?: .{1,120}?)? bison parser skeleton(?: .{1,40}?)? licen[cs]e|permission(?: .{1,60}?)? bison parser skeleton", 0.9),
    ("gpl-openssl-exception", 0, "openssl library", r"permission to link (?:the code of )?.{0,80}?with the openssl library", 0.93),
    ("gfdl", 1, "invariant sections", r"free documentation licen[cs]e(?: .{1,160}?)? with no invariant sections", 0.95),
    ("gfdl", 1, "permission is granted to copy distribute", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", 0.99),
    ("gfdl", 2, "front cover texts", r"no front cover texts and no back cover texts a copy of the licen[cs]e", 0.9),
    ("gnu-manual", 2, "verbatim copies of this manual", r"permission is granted to make and distribute verbatim copies of this manual", 0.9),
    ("copyleft", 3, "copyleft", r"(?:strong|weak|free) copyleft licen[cs]e|copyleft all wrongs reserved", 0.5),
    ("gpl-family", 3, "gpl", r"(?:under|the) (?:gnu )?gpl licen[cs]e|licen[cs]ed? under (?:the )?(?:gnu )?gpl", 0.75),
    ("lgpl", 3, "lgpl", r"(?:under|the) (?:gnu )?lgpl licen[cs]e|licen[cs]ed? under (?:the )?(?:gnu )?lgpl", 0.75),
    ("agpl", 3, "agpl", r"(?:under|the) (?:gnu )?agpl licen[cs]e|licen[cs]ed? under (?:the )?(?:gnu )?agpl", 0.75),
    # Weak copyleft.
    ("mpl-1.1", 1, "contents of this file are subject to the mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", 0.99),
    ("mpl-2.0", 1, "source code form is subject", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", 0.99),
    ("mpl-2.0", 1, "mpl was not distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at (?:https? )?(?:www )?mozilla org", 0.98),
    ("mpl-2.0-no-copyleft", 0, "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses as defined by the mozilla public licen[cs]e", 0.99),
    ("mpl-tri", 0, "alternatively the contents of this file", r"alternatively the contents of this file may be used under the terms of (?:either )?(?:of )?the gnu (?:lesser )?general public licen[cs]e", 0.95),
    ("npl", 0, "netscape public", r"netscape public licen[cs]e(?: version)?(?: 1 [01])?", 0.96),
    ("cddl-1.0", 1, "common development and distribution", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", 0.98),
    ("cddl-1.0", 2, "covered software is provided", r"covered software is provided under this licen[cs]e on an as is basis", 0.75),
    ("epl-1.0", 1, "accompanying program is provided", r"the accompanying program is provided under the terms of this eclipse public licen[cs]e", 0.97),
    ("epl-2.0", 1, "made available under the terms of the eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e", 0.96),
    ("epl-2.0", 2, "secondary licenses when the conditions", r"made available under the following secondary licenses when the conditions for such availability(?: .{1,80}?)? licen[cs]e|secondary licenses when the conditions for such availability", 0.9),
    ("cpl-1.0", 1, "accompanying program is provided under", r"the accompanying program is provided under the terms of this common public licen[cs]e", 0.97),
    ("ipl-1.0", 1, "this ibm public", r"the accompanying program is provided under the terms of this ibm public licen[cs]e", 0.98),
    ("cecill", 0, "cecill", r"(?:governed by the )?cecill(?: [bc])? (?:free software )?licen[cs]e", 0.95),
    ("cecill", 1, "french law", r"under french law and abiding by the rules of distribution of free software(?: .{1,80}?)? licen[cs]e|licen[cs]e under french law and abiding by the rules of distribution", 0.9),
    ("eupl", 1, "eupl", r"licen[cs]ed under the eupl(?: version)?(?: 1 [0-2])?", 0.96),
    ("lppl-1.3", 0, "latex project", r"latex project public licen[cs]e(?: either)?(?: version)?(?: 1 [0-3] ?[abc]?)?", 0.97),
    ("qpl", 0, "q public", r"(?:the )?q public licen[cs]e(?: version)?(?: 1 0)?", 0.95),
    ("sissl", 0, "sun industry", r"sun industry standards source licen[cs]e(?: version)?(?: 1 [12])?", 0.97),
    ("spl", 0, "sun public", r"sun public licen[cs]e(?: version)?(?: 1 0)?", 0.96),
    ("apsl", 1, "apple public source", r"contains original code and or modifications of original code as defined in and that are subject to the apple public source licen[cs]e", 0.99),
    ("rpsl", 0, "realnetworks", r"realnetworks (?:public|community) source licen[cs]e", 0.97),
    ("rpl-1.5", 0, "reciprocal public", r"reciprocal public licen[cs]e(?: version)?(?: 1 [15])?", 0.96),
    ("osl-3.0", 1, "open software", r"licensed under the open software licen[cs]e version 3 0", 0.98),
    ("afl", 1, "academic free", r"licensed under the academic free licen[cs]e version [1-3] [0-2]", 0.98),
    ("nosl", 0, "netizen open source", r"netizen open source licen[cs]e", 0.96),
    ("nasa", 0, "nasa open source", r"nasa open source agreement(?: version)?(?: 1 [13])? licen[cs]e|licen[cs]e(?: .{1,20}?)? nasa open source agreement", 0.95),
    ("nposl", 0, "non profit open software", r"non profit open software licen[cs]e", 0.97),
    ("motosoto", 0, "motosoto", r"motosoto open source licen[cs]e", 0.97),
    ("nokia", 0, "nokia open source", r"nokia open source licen[cs]e", 0.97),
    ("oclc", 0, "oclc research", r"oclc research public licen[cs]e", 0.97),
    ("sugarcrm", 0, "sugarcrm public", r"sugarcrm public licen[cs]e", 0.97),
    ("vsl", 0, "vovida software", r"vovida software licen[cs]e", 0.97),
    ("watcom", 0, "sybase open watcom", r"sybase open watcom public licen[cs]e", 0.97),
    ("wxwindows", 0, "wxwindows", r"wxwindows library licen[cs]e", 0.97),
    ("zpl", 0, "zope public", r"zope public licen[cs]e(?: version)?(?: 2 [01])?", 0.97),
    ("xfree86", 0, "xfree86", r"xfree86 licen[cs]e(?: version)?(?: 1 [01])?", 0.95),
    ("xnet", 0, "x net licen", r"x net licen[cs]e", 0.9),
    ("ypl", 0, "yahoo public", r"yahoo public licen[cs]e(?: version)?(?: 1 [01])?", 0.96),
    ("zend", 0, "zend engine", r"zend engine licen[cs]e(?: version)?(?: 2 0)?", 0.97),
    ("zimbra", 0, "zimbra public", r"zimbra public licen[cs]e(?: version)?(?: 1 [34])?", 0.97),
    ("ofl-1.1", 1, "sil open font", r"this font software is licen[cs]ed under the sil open font licen[cs]e", 0.99),
    ("ofl-1.1", 1, "reserved font name", r"with reserved font name(?: .{1,60}?)? licen[cs]e|no modified version of the font software may use the reserved font name", 0.93),
    ("bitstream-vera", 0, "bitstream vera", r"bitstream vera is a trademark of bitstream inc permission is hereby granted", 0.97),
    ("ubuntu-font", 0, "ubuntu font", r"ubuntu font licen[cs]e(?: version)?(?: 1 0)?", 0.97),
    ("ipa-font", 0, "ipa font", r"ipa font licen[cs]e(?: agreement)?(?: v1 0)?", 0.97),
    ("arphic", 0, "arphic public", r"arphic public licen[cs]e", 0.97),
    ("baekmuk", 0, "baekmuk", r"baekmuk (?:batang(?: .{1,60}?)? )?fonts?(?: .{1,60}?)? copyright|baekmuk licen[cs]e", 0.9),
    # Libraries and languages.
    ("zlib", 1, "must not be misrepresented", r"permission is granted to anyone to use this software for any purpose(?: .{1,300}?)? must not be misrepresented", 0.97),
    ("zlib", 2, "permission is granted to anyone", r"permission is granted to anyone to use this software for any purpose including commercial applications", 0.95),
    ("libpng", 1, "png reference library", r"png reference library licen[cs]e(?: version)?(?: 2)?", 0.97),
    ("libtiff", 0, "sam leffler", r"the names of sam leffler and silicon graphics may not be used in any advertising(?: .{1,80}?)? permission", 0.98),
    ("libjpeg", 0, "independent jpeg group", r"this software is based in part on the work of the independent jpeg group(?: licen[cs]e| copyright)", 0.9),
    ("ijg", 1, "permission is hereby granted to use copy modify", r"permission is hereby granted to use copy modify and distribute this software or portions thereof for any purpose without fee", 0.97),
    ("freetype", 0, "freetype", r"(?:the )?freetype (?:project )?licen[cs]e", 0.95),
    ("freetype", 1, "portions of this software are copyright", r"portions of this software are copyright(?: .{1,20}?)? the freetype project", 0.95),
    ("openssl", 1, "must not be used to endorse", r"the names openssl toolkit and openssl project must not be used to endorse or promote products", 0.98),
    ("ssleay", 0, "eric young", r"this product includes cryptographic software written by eric young(?: .{1,40}?)? (?:licen[cs]e|copyright)|copyright(?: .{1,20}?)? eric young eay cryptsoft com", 0.95),
    ("python-2.0", 1, "psf licen", r"psf licen[cs]e agreement for python", 0.97),
    ("python-2.0", 2, "psf is making python available", r"psf is making python available to licensee on an as is basis", 0.98),
    ("cnri-python", 0, "cnri", r"cnri (?:open source )?licen[cs]e agreement(?: for python)?", 0.96),
    ("beopen-python", 0, "beopen", r"beopen (?:com )?(?:python )?(?:open source )?licen[cs]e agreement", 0.96),
    ("perl", 0, "same terms as perl", r"(?:redistribute it and or modify it )?under the same terms as perl itself(?:(?: .{1,40}?)? licen[cs]e)|licen[cs]ed under the same terms as perl", 0.95),
    ("artistic-1.0", 1, "artistic control", r"copyright holder maintains some semblance of artistic control over the development of the package", 0.98),
    ("artistic-2.0", 1, "artistic license 2 0", r"this package is licen[cs]ed under the artistic license 2 0|the artistic license 2 0 copyright", 0.97),
    ("ruby", 1, "ruby is copyright", r"ruby is copyright(?:ed)? free software by yukihiro matsumoto", 0.98),
    ("php-3.01", 1, "of the php licen", r"subject to version 3 0 ?1 of the php licen[cs]e", 0.98),
    ("tcl", 0, "authors hereby grant permission", r"the authors hereby grant permission to use copy modify distribute and licen[cs]e this software", 0.98),
    ("lua", 1, "lua licen", r"(?:the )?lua licen[cs]e(?: copyright)?", 0.85),
    ("vim", 0, "vim licen", r"(?:the )?vim licen[cs]e", 0.93),
    ("w3c", 0, "w3c", r"w3c (?:r )?software (?:notice and|and document notice and) licen[cs]e", 0.97),
    ("w3c", 1, "w3c document", r"w3c document licen[cs]e", 0.96),
    ("unicode-dfs", 0, "unicode inc", r"unicode inc licen[cs]e agreement data files and software", 0.98),
    ("unicode-dfs", 1, "unicode data files", r"permission is hereby granted(?: .{1,100}?)? unicode data files and any associated documentation", 0.98),
    ("icu", 0, "icu licen", r"icu licen[cs]e(?: icu 1 8 1 and later)?", 0.95),
    ("boost", 1, "boost software", r"distributed under the boost software licen[cs]e version 1 0", 0.99),
    ("boost", 1, "machine executable object code", r"works are solely in the form of machine executable object code generated by a source language processor(?: .{1,200}?)? as is", 0.95),
    ("postgresql", 1, "university of california be liable", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages", 0.93),
    ("info-zip", 0, "info zip", r"info zip (?:copyright and )?licen[cs]e", 0.97),
    ("bzip2", 0, "bzip2", r"bzip2 (?:and libbzip2 )?licen[cs]e|bzip2 and associated library libbzip2(?: .{1,40}?)? copyright", 0.93),
    ("imagemagick", 0, "imagemagick", r"imagemagick (?:studio )?licen[cs]e", 0.95),
    ("sqlite-public-domain", 0, "disclaims copyright to this source", r"the author disclaims copyright to this source code", 0.97),
    ("naumen", 0, "naumen public", r"naumen public licen[cs]e", 0.97),
    ("frameworx", 0, "frameworx", r"frameworx open licen[cs]e", 0.97),
    ("entessa", 0, "entessa public", r"entessa public licen[cs]e", 0.97),
    ("eiffel", 0, "eiffel forum", r"eiffel forum licen[cs]e(?: version)?(?: [12])?", 0.97),
    ("fsl", 0, "functional source", r"functional source licen[cs]e(?: version)?(?: 1 [01])?", 0.96),
    ("attribution-assurance", 0, "attribution assurance", r"attribution assurance licen[cs]e", 0.97),
    ("ca-tosl", 0, "computer associates trusted", r"computer associates trusted open source licen[cs]e", 0.97),
    ("lucent", 0, "lucent public", r"lucent public licen[cs]e(?: version)?(?: 1 0 ?2?)?", 0.97),
    ("miros", 0, "miros licen", r"(?:the )?miros licen[cs]e", 0.95),
    ("simpl", 0, "simple public", r"simple public licen[cs]e(?: version)?(?: 2 0)?", 0.95),
    ("oset", 0, "oset", r"oset (?:foundation )?public licen[cs]e", 0.96),
    ("multics", 0, "multics licen", r"multics licen[cs]e", 0.95),
    ("jabber", 0, "jabber open source", r"jabber open source licen[cs]e", 0.97),
    ("intel", 0, "intel open source", r"intel open source licen[cs]e", 0.97),
    ("parity", 0, "parity public", r"parity public licen[cs]e(?: version)?(?: [67] 0 0)?", 0.96),
    ("polyform", 0, "polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter|internal use|free trial) licen[cs]e(?: 1 0 0)?", 0.98),
    ("prosperity", 0, "prosperity public", r"prosperity public licen[cs]e(?: version)?(?: [23] 0 0)?", 0.97),
    ("commons-clause", 0, "commons clause", r"commons clause (?:licen[cs]e )?condition|commons clause licen[cs]e", 0.97),
    ("commons-clause", 1, "right to sell the software", r"the licen[cs]e does not grant to you the right to sell the software", 0.97),
    ("confluent", 0, "confluent community", r"confluent community licen[cs]e(?: agreement)?", 0.97),
    ("timescale", 0, "timescale", r"timescale licen[cs]e(?: agreement)?", 0.9),
    ("cockroach", 0, "cockroachdb", r"cockroachdb (?:community|software) licen[cs]e", 0.97),
    ("redis-source-available", 0, "redis source available", r"redis source available licen[cs]e(?: agreement)?", 0.97),
    ("busl-1.1", 1, "change date", r"business source licen[cs]e(?: .{1,300}?)? change date|change date(?: .{1,80}?)? change licen[cs]e", 0.9),
    ("busl-1.1", 1, "additional use grant", r"additional use grant(?: .{1,120}?)? licen[cs]e|licen[cs]or(?: .{1,60}?)? additional use grant", 0.85),
    ("elastic-2.0", 1, "hosted or managed service", r"licen[cs]e(?: .{1,600}?)? you may not provide the software to third parties as a hosted or managed service|may not provide the software to third parties as a hosted or managed service(?: .{1,200}?)? licen[cs]e", 0.95),
    ("sspl-1.0", 1, "service source code", r"service source code(?: .{1,160}?)? under the terms of this licen[cs]e", 0.9),
    ("hippocratic", 0, "hippocratic", r"hippocratic licen[cs]e(?: version)?(?: [1-3] [01])?", 0.97),
    ("anti-996", 0, "anti 996", r"anti 996 licen[cs]e(?: version)?(?: 1 0)?", 0.98),
    ("do-no-harm", 0, "do no harm", r"do no harm licen[cs]e", 0.95),
    ("cooperative", 0, "cooperative non violent", r"cooperative non violent (?:public )?licen[cs]e", 0.97),
    ("peer-production", 0, "peer production", r"peer production licen[cs]e", 0.95),
    ("blue-oak", 0, "blue oak", r"blue oak model licen[cs]e(?: 1 0 0)?", 0.98),
    ("mulan", 1, "mulan", r"is licensed under mulan (?:psl|publ|permissive software licen[cs]e)(?: v ?[12])?", 0.97),
    ("cern-ohl", 0, "cern open hardware", r"cern open hardware licen[cs]e(?: version)?(?: [12](?: [0-2])?)?(?: (?:strongly|weakly) reciprocal| permissive)?", 0.98),
    ("tapr-ohl", 0, "tapr open hardware", r"tapr open hardware licen[cs]e(?: version)?(?: 1 0)?", 0.98),
    ("solderpad", 0, "solderpad", r"solderpad hardware licen[cs]e(?: version)?(?: [02] [51])?", 0.98),
    # Data, models, documents and media.
    ("cc0-1.0", 1, "extent possible under law", r"to the extent possible under law(?: .{1,120}?)? has waived all copyright and related or neighboring rights", 0.98),
    ("cc0-1.0", 1, "no copyright the person", r"no copyright the person who associated a work with this deed has dedicated the work to the public domain", 0.99),
    ("cc-public-domain-mark", 0, "free of known restrictions under copyright", r"this work (?:has been identified as being|is) free of known restrictions under copyright law", 0.98),
    ("cc-by-only", 1, "must give appropriate credit", r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made", 0.9),
    ("cc-by-sa", 1, "distribute your contributions under the same", r"if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e as the original", 0.96),
    ("cc-by-nd", 1, "may not distribute the modified material", r"if you remix transform or build upon the material you may not distribute the modified material(?:(?: .{1,40}?)? licen[cs]e)|licen[cs]e(?: .{1,400}?)? you may not distribute the modified material", 0.93),
    ("cc-by-nc", 1, "use the material for commercial purposes", r"licen[cs]e(?: .{1,400}?)? you may not use the material for commercial purposes", 0.93),
    ("creative-commons", 2, "creative commons licen", r"(?:a|the|under) creative commons licen[cs]e", 0.75),
    ("creative-commons", 3, "creative commons", r"creative commons zero|creative commons (?:corporation|legal code)", 0.6),
    ("cc-sampling", 0, "sampling plus", r"creative commons sampling plus(?: 1 0)?(?: licen[cs]e)?", 0.97),
    ("cc-devnations", 0, "developing nations", r"creative commons developing nations(?: 2 0)?(?: licen[cs]e)?", 0.97),
    ("odbl-1.0", 1, "open database", r"this(?: .{1,60}?)? is made available under the open database licen[cs]e", 0.98),
    ("odbl-1.0", 1, "database contents licen", r"any rights in individual contents of the database are licen[cs]ed under the database contents licen[cs]e", 0.98),
    ("dbcl-1.0", 0, "database contents licen", r"database contents licen[cs]e(?: v ?1 0)?", 0.93),
    ("odc-by-1.0", 1, "odc attribution", r"made available under the odc attribution licen[cs]e", 0.98),
    ("pddl-1.0", 1, "opendatacommons org", r"opendatacommons org licenses pddl(?: 1 0)?", 0.98),
    ("odbl-1.0", 1, "opendatacommons org", r"opendatacommons org licenses odbl(?: 1 0)?", 0.98),
    ("odc-by-1.0", 1, "opendatacommons org licenses by", r"opendatacommons org licenses by(?: 1 0)?", 0.98),
    ("cdla-permissive", 0, "community data licen", r"community data licen[cs]e agreement permissive(?: version)?(?: [12] 0)?", 0.98),
    ("cdla-sharing", 0, "community data licen", r"community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?", 0.98),
    ("c-uda", 0, "computational use of data", r"computational use of data agreement(?: c uda)?(?: 1 0)?(?: licen[cs]e)|licen[cs]e(?: .{1,20}?)? computational use of data agreement", 0.95),
    ("open-use-of-data", 0, "open use of data", r"open use of data agreement(?: o uda)?(?:(?: .{1,20}?)? licen[cs]e)|licen[cs]ed?(?: .{1,20}?)? open use of data agreement", 0.93),
    ("ogl-uk", 1, "public sector information licen", r"contains public sector information licen[cs]ed under the open government licen[cs]e", 0.99),
    ("ogl-canada", 0, "open government licence canada", r"open government licence canada", 0.98),
    ("nlod", 0, "norwegian licen", r"norwegian licen[cs]e for open government data", 0.98),
    ("etalab", 0, "licence ouverte", r"licence ouverte(?: open licence)?(?: version)?(?: [12] 0)?", 0.97),
    ("dl-de-by", 0, "datenlizenz deutschland", r"datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?(?: .{1,60}?)? licen[cs]e|licen[cs]e(?: .{1,20}?)? datenlizenz deutschland", 0.95),
    ("crown-copyright", 1, "crown copyright", r"(?:subject to )?crown copyright (?:material|and database right|protection|all rights reserved|reserved)", 0.8),
    ("gutenberg", 0, "project gutenberg", r"(?:the )?(?:full )?project gutenberg(?: tm)? licen[cs]e", 0.98),
    ("gutenberg", 1, "project gutenberg", r"under the terms of the project gutenberg licen[cs]e included with this ebook", 0.99),
    ("open-publication", 0, "open publication licen", r"open publication licen[cs]e(?: version)?(?: v ?1 0)?", 0.97),
    ("open-content", 0, "open content licen", r"open content licen[cs]e", 0.95),
    ("linux-man", 0, "verbatim copies of this manual", r"permission is granted to make and distribute verbatim copies of this manual provided the copyright notice and this permission notice are preserved on all copies", 0.97),
    ("free-art", 0, "free art licen", r"free art licen[cs]e(?: 1 [23])?", 0.97),
    ("design-science", 0, "design science licen", r"design science licen[cs]e", 0.97),
    ("gfml", 1, "free music public", r"free music public licen[cs]e", 0.97),
    ("openmd", 0, "openmdw", r"openmdw licen[cs]e(?: agreement)?(?: version)?(?: 1 [01])?", 0.97),
    ("bigscience-rail", 0, "bigscience", r"bigscience (?:bloom )?rail(?: 1 0)? licen[cs]e", 0.98),
    ("openrail", 1, "responsible ai licen", r"responsible ai licen[cs]es?", 0.93),
    ("gemma", 0, "gemma terms of use", r"gemma terms of use(?: .{1,60}?)? licen[cs]e|licen[cs]e(?: .{1,40}?)? gemma terms of use", 0.95),
    ("model-licence", 2, "model licen", r"(?:community|research|non ?commercial) model licen[cs]e(?: agreement)?", 0.6),
    ("llama-community", 1, "meta platforms inc all rights reserved", r"llama(?: .{1,60}?)? copyright(?: .{1,20}?)? meta platforms inc all rights reserved", 0.95),
    ("ai-training-ban", 1, "machine learning or artificial intelligence", r"(?:without|no) (?:express |prior |written )*permission(?: .{1,60}?)? (?:train|training)(?: .{1,40}?)? machine learning or artificial intelligence", 0.85),
    ("ai-training-ban", 1, "text and data mining", r"(?:all )?rights reserved including (?:those )?for text and data mining(?: ai training and similar technologies)?", 0.9),
    # Proprietary and commercial terms.
    ("proprietary", 1, "end user licen", r"end user licen[cs]e agreement(?: eula)?", 0.8),
    ("proprietary", 1, "read this licen", r"please read this licen[cs]e agreement carefully before (?:using|installing|downloading)", 0.85),
    ("proprietary", 1, "by installing", r"by installing (?:copying )?(?:or otherwise )?using (?:the|this) (?:software|product) you agree to be bound by the terms of this (?:eula |licen[cs]e )+(?:agreement)?", 0.9),
    ("proprietary", 1, "reverse engineer", r"(?:licen[cs]ee|you) (?:may not|shall not|agrees? not to) reverse engineer decompile or disassemble (?:the software )?.{0,80}?licen[cs]e|licen[cs]e(?: .{1,300}?)? reverse engineer decompile (?:or|and) disassemble", 0.85),
    ("proprietary", 1, "licensed not sold", r"the software (?:product )?is licensed not sold", 0.9),
    ("proprietary", 1, "non transferable licen", r"(?:limited |non exclusive |nonexclusive |revocable |personal )+non transferable licen[cs]e", 0.8),
    ("proprietary", 1, "unpublished", r"unpublished rights reserved under the copyright laws(?: of the united states)?", 0.93),
    ("proprietary", 1, "contains confidential", r"(?:this (?:file|document|program|software) )?contains confidential (?:and proprietary |and trade secret )?information(?: .{1,120}?)? (?:licen[cs]e|permission)", 0.8),
    ("proprietary", 1, "strictly forbidden", r"(?:dissemination|reproduction|distribution|copying) of this (?:information|material|file|document)(?: .{1,40}?)? strictly forbidden (?:unless|without) (?:the )?prior written permission", 0.93),
    ("proprietary", 2, "protected by copyright", r"protected by copyright (?:law|laws|and other intellectual property laws) and international (?:copyright )?treaties all rights reserved|protected by copyright law all rights reserved", 0.75),
    ("proprietary", 2, "required", r"(?:commercial|enterprise|perpetual|site|volume) licen[cs]e (?:is )?required", 0.75),
    ("proprietary", 2, "terms of your licen", r"subject to the terms of your licen[cs]e agreement (?:with|for)", 0.8),
    ("proprietary", 2, "government", r"use duplication or disclosure by the (?:us |u s |united states )?government is subject to restrictions(?: .{1,120}?)? (?:licen[cs]e|rights reserved)|government restricted rights(?: .{1,80}?)? licen[cs]e", 0.8),
    ("shareware", 1, "shareware", r"shareware licen[cs]e(?: agreement)?|this (?:is )?shareware(?: .{1,80}?)? licen[cs]e", 0.8),
    ("freeware", 1, "freeware", r"freeware licen[cs]e(?: agreement)?|licen[cs]ed as freeware", 0.8),
    ("evaluation-only", 1, "evaluation", r"for evaluation (?:purposes|use) only", 0.75),
    ("trial", 2, "trial licen", r"(?:free )?trial licen[cs]e", 0.6),
    ("personal-use-only", 1, "personal", r"for (?:your )?personal (?:and )?(?:non ?commercial )?(?:use|purposes) only", 0.7),
    ("internal-use-only", 1, "internal", r"for internal (?:use|business purposes|purposes) only", 0.7),
    ("editorial-use-only", 1, "editorial", r"for editorial (?:use|purposes) only", 0.75),
    ("getty", 1, "royalty free licen", r"royalty free licen[cs]e", 0.7),
    ("getty", 1, "rights managed licen", r"rights managed licen[cs]e", 0.75),
    ("press-copyright", 1, "may not be published broadcast", r"this material may not be published broadcast rewritten (?:or )?redistributed (?:without permission|.{0,40}?all rights reserved)|all rights reserved this material may not be published broadcast rewritten or redistributed", 0.97),
    ("press-copyright", 2, "for reprints", r"for reprints (?:and|or) permissions?(?: .{1,60}?)? copyright|copyright(?: .{1,60}?)? for reprints (?:and|or) permissions?", 0.75),
    ("publisher", 1, "stored in a retrieval system", r"no part of this(?: .{1,40}?)? may be reproduced stored in a retrieval system or transmitted in any form", 0.95),
    ("publisher", 1, "stored in a retrieval system", r"stored in a retrieval system or transmitted in any form or by any means(?: .{1,120}?)? permission", 0.93),
    ("publisher", 1, "brief quotations", r"brief quotations embodied in critical (?:articles and )?reviews(?: .{1,160}?)? (?:permission|copyright)|permission(?: .{1,200}?)? brief quotations embodied in critical", 0.85),
    ("publisher", 1, "moral right", r"the moral right of the author has been asserted(?: .{1,60}?)? (?:copyright|all rights reserved)|copyright(?: .{1,100}?)? moral rights? of the author", 0.8),
    ("publisher", 2, "library of congress", r"copyright(?: .{1,120}?)? library of congress cataloging in publication data", 0.7),
    ("journal-oa", 0, "open access article", r"open access article (?:distributed )?under the (?:terms (?:and conditions )?of the )?creative commons attribution(?: non ?commercial)? licen[cs]e", 0.98),
    ("journal-oa", 1, "licensee mdpi", r"licensee mdpi basel switzerland", 0.85),
    ("journal", 1, "copyright clearance center", r"permission(?: .{1,80}?)? copyright clearance center", 0.85),
    ("acm", 0, "permission to make digital or hard copies", r"permission to make digital or hard copies of all or part of this work for personal or classroom use is granted without fee", 0.99),
    ("ieee", 0, "personal use of this material is permitted", r"personal use of this material is permitted (?:however )?permission (?:from ieee must be obtained|to reprint)", 0.98),
    ("arxiv", 0, "arxiv", r"arxiv(?: org)? (?:perpetual )?non ?exclusive licen[cs]e(?: to distribute)?", 0.97),
    ("elsevier-user", 0, "elsevier user licen", r"elsevier user licen[cs]e", 0.98),
    ("copyright-notice", 3, "copyright", r"all (?:content|contents|material|materials|text and images) (?:is|are) copyright", 0.5),
    ("copyright-notice", 3, "copyright holder", r"without (?:the )?(?:prior |express |written )*permission of the copyright holders?", 0.6),
    ("copyright-notice", 3, "copyright owner", r"without (?:the )?(?:prior |express |written )*permission of the copyright owners?", 0.6),
    ("copyright-notice", 3, "without prior written permission", r"without prior written permission", 0.35),
    ("reprint", 3, "with permission", r"(?:reprinted|reproduced|republished) with permission", 0.45),
    ("fair-use", 2, "fair use", r"fair use (?:notice|of copyright(?:ed)? material)(?:(?: .{1,40}?)? copyright)", 0.6),
    ("dmca", 2, "digital millennium", r"(?:under |of )?the digital millennium copyright act", 0.5),
    # Notices in other languages.
    ("all-rights", 2, "tutti i diritti", r"tutti i diritti riservati (?:licen[cz][ae]|copyright)|copyright(?: .{1,40}?)? tutti i diritti riservati", 0.8),
    ("all-rights", 2, "todos os direitos", r"copyright(?: .{1,40}?)? todos os direitos reservados", 0.8),
    ("all-rights", 2, "alle rechten", r"copyright(?: .{1,40}?)? alle rechten voorbehouden", 0.8),
    ("licence-mention", 3, "unter der", r"(?:lizenziert|veröffentlicht) unter der(?: .{1,30}?)? licen[cs]e", 0.5),
    ("licence-mention", 3, "sous licence", r"(?:distribué|publié|disponible)e?s? sous licence", 0.55),
    ("licence-mention", 3, "bajo la licencia", r"(?:publicado|distribuido|disponible|licenciado) bajo la licencia", 0.55),
    # Mentions.
    ("licence-mention", 3, "license file", r"(?:see|in|read) the (?:accompanying )?license file", 0.4),
    ("licence-mention", 3, "licen", r"dual licen[cs]ed(?: under)?", 0.45),
    ("licence-mention", 3, "licen", r"open source licen[cs]es?", 0.35),
    ("licence-mention", 3, "licen", r"free software licen[cs]es?", 0.35),
    ("licence-mention", 3, "licen", r"permissive licen[cs]es?", 0.35),
    ("licence-mention", 3, "licen", r"third party licen[cs]es?(?: and notices)?", 0.4),
    ("licence-mention", 3, "licen", r"licen[cs]e agreement", 0.3),
    ("licence-mention", 3, "licen", r"licen[cs]e (?:text|terms|information|header|notice|key)", 0.3),
    ("licence-mention", 3, "licen", r"(?:sub)?licen[cs]able", 0.3),
    ("licence-mention", 3, "licen", r"licen[cs]ed? (?:from|by)(?: .{1,40}?)? under licen[cs]e", 0.35),
    ("licence-mention", 3, "spdx license identifier", r"spdx license identifier [a-z0-9]+", 0.5),
    ("no-licence", 2, "without a licen", r"(?:provided|published|released) without a licen[cs]e", 0.5),
    ("unlicense", 1, "free to copy modify publish", r"anyone is free to copy modify publish use compile sell or distribute this software(?: .{1,200}?)? (?:copyright|public domain)", 0.95),
    ("unlicense", 1, "dedicate any and all copyright interest", r"the authors? of this software dedicate any and all copyright interest in the software to the public domain", 0.99),
    ("public-domain", 1, "waive all copyright", r"(?:i|we|the authors?) (?:hereby )?waive all copyright", 0.9),
    ("public-domain", 1, "no copyright is claimed", r"no copyright is claimed in the united states|no copyright is claimed (?:on|in) this", 0.9),
    ("public-domain", 1, "title 17", r"(?:pursuant to|under) title 17 (?:section 105 )?(?:of the )?united states code(?: .{1,120}?)? (?:copyright protection|public domain)", 0.93),
    ("public-domain", 2, "work of the u", r"work of the (?:u s|united states) government(?: .{1,120}?)? public domain", 0.85),
    ("warranty-disclaimer", 3, "warrant", r"(?:makes|make|with) no warrant(?:y|ies) (?:express or implied|of any kind)", 0.45),
    ("warranty-disclaimer", 3, "warrant", r"disclaims? all warrant(?:y|ies)", 0.45),
    ("warranty-disclaimer", 3, "warrant", r"absolutely no warrant(?:y|ies)", 0.5),
    ("warranty-disclaimer", 3, "warrant", r"warrant(?:y|ies) of (?:title|merchantability|noninfringement|non infringement)", 0.45),
    ("warranty-disclaimer", 3, "use at your own risk", r"as is use at your own risk|licen[cs]e(?: .{1,60}?)? use at your own risk", 0.4),
    ("liability-disclaimer", 3, "in no event", r"in no event (?:will|unless required)(?: .{1,80}?)? (?:be liable|copyright)", 0.45),
    ("trademark", 3, "trademark", r"(?:registered )?trademarks?(?: .{1,80}?)? used under licen[cs]e", 0.5),
    ("trademark", 3, "trademark", r"this licen[cs]e does not grant(?: .{1,80}?)? trademarks?", 0.6),
    ("patent", 3, "patent", r"patent licen[cs]e (?:grant|to make)|royalty free patent licen[cs]e", 0.5),
]
