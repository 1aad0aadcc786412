"""Fixed values of the licence scan: known sentences, names and rules, and the places of sentences that vary."""

from __future__ import annotations

_AS_IS = 'software is provided by the HOLDER "as is" and any express or implied warranties'
_HOPE = "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
_FREE = "is free software{} you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by the Free Software Foundation{} either version {}, or (at your option) any later version."

# Names that a text says it is under (identifier, licence, names).
NAMES = (
    ("apache-line", "Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2", "Apache Software License, Version 2.0", "Apache 2.0", "Apache v2", "Apache-2.0", "Apache Version 2.0")),
    ("mit-line", "MIT", ("MIT", "MIT/X11", "Expat", "MIT (Expat)")),
    ("agpl3-later-line", "AGPL-3.0-or-later", ("GNU Affero General Public License, version 3 or later", "GNU Affero General Public License v3.0 or later", "AGPLv3 or later", "AGPLv3+", "AGPL-3.0-or-later")),
    ("agpl3-line", "AGPL-3.0-only", ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "GNU AGPLv3", "AGPLv3", "AGPL v3", "AGPL-3.0")),
    ("lgpl3-later-line", "LGPL-3.0-or-later", ("GNU Lesser General Public License, version 3 or later", "GNU Lesser General Public License v3.0 or later", "LGPLv3 or later", "LGPL-3.0-or-later")),
    ("lgpl3-line", "LGPL-3.0-only", ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "GNU LGPLv3", "LGPLv3", "LGPL v3", "LGPL-3.0")),
    ("lgpl21-later-line", "LGPL-2.1-or-later", ("GNU Lesser General Public License, version 2.1 or later", "GNU Lesser General Public License v2.1 or later", "LGPLv2.1 or later", "LGPL-2.1-or-later")),
    ("lgpl21-line", "LGPL-2.1-only", ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1", "LGPL v2.1", "LGPL-2.1")),
    ("gpl3-later-line", "GPL-3.0-or-later", ("GNU General Public License, version 3 or later", "GNU General Public License v3.0 or later", "GNU GPL v3 or later", "GPLv3 or later", "GPLv3+", "GPL-3.0-or-later")),
    ("gpl3-line", "GPL-3.0-only", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GNU GPLv3", "GPLv3", "GPL v3", "GPL version 3.0", "GPL-3.0")),
    ("gpl2-later-line", "GPL-2.0-or-later", ("GNU General Public License, version 2 or later", "GNU General Public License v2.0 or later", "GNU GPL v2 or later", "GPLv2 or later", "GPLv2+", "GPL-2.0-or-later")),
    ("gpl2-line", "GPL-2.0-only", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GNU GPLv2", "GPLv2", "GPL v2", "GPL version 2.0", "GPL-2.0")),
    ("bsd3-line", "BSD-3-Clause", ("BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "BSD-3-Clause")),
    ("bsd2-line", "BSD-2-Clause", ("BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD")),
    ("isc-line", "ISC", ("ISC",)),
    ("zlib-line", "Zlib", ("zlib", "zlib/libpng")),
    ("unlicense-line", "Unlicense", ("Unlicense",)),
    ("boost-line", "BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software License")),
    ("mpl2-line", "MPL-2.0", ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL v2", "MPL-2.0")),
    ("epl2-line", "EPL-2.0", ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0", "EPL v2.0")),
    ("epl1-line", "EPL-1.0", ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0", "EPL v1.0")),
    ("cddl-line", "CDDL-1.0", ("Common Development and Distribution License", "Common Development and Distribution License 1.0", "CDDL", "CDDL 1.0")),
    ("artistic2-line", "Artistic-2.0", ("Artistic License 2.0", "Artistic License, version 2.0", "Artistic 2.0")),
    ("eupl-line", "EUPL-1.2", ("European Union Public Licence 1.2", "European Union Public Licence v. 1.2", "EUPL 1.2", "EUPL, Version 1.2")),
    ("mspl-line", "MS-PL", ("Microsoft Public License", "Microsoft Public License (Ms-PL)", "Ms-PL")),
    ("psf2-line", "PSF-2.0", ("Python Software Foundation License", "Python Software Foundation License, version 2", "PSF")),
    ("wtfpl-line", "WTFPL", ("WTFPL", "WTFPL, Version 2")),
    *((f"cc-{key}-line", f"CC-{key.upper()}-4.0", (f"CC {key.upper()} 4.0", f"Creative Commons {said} 4.0 International License", f"Creative Commons {said} 4.0 International (CC {key.upper()} 4.0)", f"Creative Commons {said} 4.0"))
      for key, said in (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"), ("by-nc", "Attribution-NonCommercial"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))),
)


def _lines():
    for key, _, names in NAMES:
        for name in names:
            yield key, f"Licensed under the {name}."
            said = name if "licen" in name.lower() else f"{name} License"
            yield key, f"Licensed under the {said}."
            yield key, f"Released under the {said}."


# Known licence sentences (identifier, sentence).  HOLDER and NAME stand for what VARIABLES finds.
SENTENCES = (
    ("apache-line", "Licensed under the Apache License, Version 2.0."),
    ("apache-head", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-copy", "You may obtain a copy of the License at"),
    ("apache-disclaim", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("apache-see", "See the License for the specific language governing permissions and limitations under the License."),
    ("apache-title", "Apache License Version 2.0, January 2004"),
    ("mit-line", "Released under the MIT License."),
    ("mit-line", "Licensed under the MIT License."),
    ("mit-line", "This project is licensed under the MIT License."),
    ("mit-name", "The MIT License (MIT)"),
    ("mit-name", "The MIT License"),
    ("mit-name", "MIT License"),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-disclaim", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("gpl3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-title", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("gpl2-title", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("lgpl3-title", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl21-title", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("agpl3-title", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *((f"{key}-free", f"{what} {_FREE.format(colon, kind, comma, version)}") for key, kind, number in (("gpl", "", "3"), ("gpl2", "", "2"), ("lgpl3", "Lesser", "3"), ("lgpl21", "Lesser", "2.1"), ("lgpl2", "Library", "2"), ("agpl3", "Affero", "3")) for version in (f"{number} of the License", number) for what in ("This program", "This library", "NAME") for colon, comma in ((":", ","), (";", ";"))),
    ("gpl2-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    *(("gpl-hope", f"{what} {_HOPE}") for what in ("This program", "This library", "NAME")),
    ("gpl-details", "See the GNU General Public License for more details."),
    ("lgpl-details", "See the GNU Lesser General Public License for more details."),
    ("library-details", "See the GNU Library General Public License for more details."),
    ("agpl-details", "See the GNU Affero General Public License for more details."),
    ("cc-by-nc-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-line", "Licensed under CC BY 4.0."),
    ("cc-by-sa-line", "Licensed under CC BY-SA 4.0."),
    ("cc-by-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-line", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0-line", "To the extent possible under law, HOLDER has waived all copyright and related or neighboring rights to this work."),
    ("bsd-redist", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-endorse", "Neither the name of HOLDER nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-disclaim", f"THIS {_AS_IS}, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."),
    ("isc-name", "ISC License"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd0-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("mpl2-head", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense-head", "This is free and unencumbered software released into the public domain."),
    ("unlicense-grant", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("boost-name", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("boost-line", "Distributed under the Boost Software License, Version 1.0."),
    ("zlib-as-is", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    *((f"spdx-{x}", f"SPDX-License-Identifier: {x}") for x in ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "CC0-1.0", "Unlicense")),
    ("epl2-title", "Eclipse Public License - v 2.0"),
    ("epl1-title", "Eclipse Public License - v 1.0"),
    ("epl2-head", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("epl2-head", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at"),
    ("epl1-head", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at"),
    ("cddl-title", "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0"),
    ("cddl-head", 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License").'),
    ("artistic2-title", "The Artistic License 2.0"),
    ("artistic2-title", "Artistic License 2.0"),
    ("eupl-title", "EUROPEAN UNION PUBLIC LICENCE v. 1.2"),
    ("eupl-head", 'Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the "Licence");'),
    ("mspl-title", "Microsoft Public License (Ms-PL)"),
    ("psf2-title", "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2"),
    ("wtfpl-title", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    *_lines(),
    ("reserved", "All rights reserved."),
)

# Licence rules, most specific first (rule, licence, identifiers in order).
RULES = (
    ("apache-header", "Apache-2.0", ("apache-head", "apache-copy", "apache-disclaim")),
    ("apache-full", "Apache-2.0", ("apache-title",)),
    ("mit-full", "MIT", ("mit-name", "mit-grant", "mit-notice")),
    ("mit-text", "MIT", ("mit-grant", "mit-notice")),
    ("agpl3-header", "AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "agpl-details")),
    ("lgpl3-header", "LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope", "lgpl-details")),
    ("lgpl21-header", "LGPL-2.1-or-later", ("lgpl21-free", "gpl-hope", "lgpl-details")),
    ("gpl3-header", "GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    ("gpl2-header", "GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details")),
    ("gpl2-only-header", "GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-details")),
    ("lgpl2-header", "LGPL-2.0-or-later", ("lgpl2-free", "gpl-hope", "library-details")),
    ("agpl3-full", "AGPL-3.0-only", ("agpl3-title",)),
    ("lgpl3-full", "LGPL-3.0-only", ("lgpl3-title",)),
    ("lgpl21-full", "LGPL-2.1-only", ("lgpl21-title",)),
    ("gpl3-full", "GPL-3.0-only", ("gpl3-title",)),
    ("gpl2-full", "GPL-2.0-only", ("gpl2-title",)),
    ("bsd-3-full", "BSD-3-Clause", ("bsd-redist", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-disclaim")),
    ("bsd-3", "BSD-3-Clause", ("bsd-redist", "bsd-endorse")),
    ("bsd-2-full", "BSD-2-Clause", ("bsd-redist", "bsd-source", "bsd-binary", "bsd-disclaim")),
    ("bsd-2", "BSD-2-Clause", ("bsd-redist",)),
    ("isc", "ISC", ("isc-grant",)),
    ("bsd-0", "0BSD", ("bsd0-grant",)),
    ("mpl2-header", "MPL-2.0", ("mpl2-head", "mpl2-copy")),
    ("unlicense", "Unlicense", ("unlicense-head", "unlicense-grant")),
    ("zlib", "Zlib", ("zlib-as-is", "zlib-grant")),
    ("boost", "BSL-1.0", ("boost-name",)),
    ("epl2-header", "EPL-2.0", ("epl2-head",)),
    ("epl1-header", "EPL-1.0", ("epl1-head",)),
    ("cddl-header", "CDDL-1.0", ("cddl-head",)),
    ("eupl-header", "EUPL-1.2", ("eupl-head",)),
    ("epl2-full", "EPL-2.0", ("epl2-title",)),
    ("epl1-full", "EPL-1.0", ("epl1-title",)),
    ("cddl-full", "CDDL-1.0", ("cddl-title",)),
    ("eupl-full", "EUPL-1.2", ("eupl-title",)),
    ("artistic2-full", "Artistic-2.0", ("artistic2-title",)),
    ("mspl-full", "MS-PL", ("mspl-title",)),
    ("psf2-full", "PSF-2.0", ("psf2-title",)),
    ("wtfpl-full", "WTFPL", ("wtfpl-title",)),
    ("mpl2-short", "MPL-2.0", ("mpl2-head",)),
    ("apache-short", "Apache-2.0", ("apache-head",)),
    *((f"{key[:-5]}-reference", licence, (key,)) for key, licence, _ in NAMES),
    # The headers of one licence without the paragraphs that follow.
    *((f"{key}-free-only", licence, (f"{key}-free",)) for key, licence in (("agpl3", "AGPL-3.0-or-later"), ("lgpl3", "LGPL-3.0-or-later"), ("lgpl21", "LGPL-2.1-or-later"), ("lgpl2", "LGPL-2.0-or-later"), ("gpl", "GPL-3.0-or-later"), ("gpl2", "GPL-2.0-or-later"))),
    ("cc0-waiver", "CC0-1.0", ("cc0-line",)),
    *((key, key[5:], (key,)) for key, _ in SENTENCES if key.startswith("spdx-")),
    ("proprietary", "Proprietary", ("reserved",)),
)

# Places of normalised sentences that vary, and how they are written in the table.
_ANY = r"[a-z0-9 \n]{1,120}?"
VARIABLES = (
    (r"licence", "license"),
    (r"([|\n ])(?:version|ver|v)[ \n]*([0-9])", r"\1version \2"),
    (rf"neither[ \n]+the[ \n]+names?[ \n]+of[ \n]+{_ANY}[ \n]+nor[ \n]+the[ \n]+names[ \n]+of[ \n]+(?:its|their|any|other)[ \n]+contributors", "neither the name of holder nor the names of its contributors"),
    (r"software[ \n]+is[ \n]+provided[ \n]+by[ \n]+(?:the[ \n]+)?[a-z0-9 \n]{1,80}?[ \n]+as[ \n]+is[ \n]+and[ \n]+any[ \n]+express(?:ed)?[ \n]+or", "software is provided by the holder as is and any express or"),
    (rf"under[ \n]+law[ \n]+{_ANY}[ \n]+has[ \n]+waived", "under law holder has waived"),
    (rf"([|\n] ?)[a-z0-9 ]{{1,60}}?[ \n]+is[ \n]+free[ \n]+software[ \n]+you[ \n]+can", r"\1name is free software you can"),
    (rf"([|\n] ?)[a-z0-9 ]{{1,60}}?[ \n]+is[ \n]+distributed[ \n]+in[ \n]+the[ \n]+hope", r"\1name is distributed in the hope"),
)

# How a sentence says that something is under a licence, and the one form of it.
_W = r"[ \n]+"
_SUBJECT = rf"(?:(?:this|the){_W}(?:project|software|work|code|source{_W}code|file|package|library|program|repository|module|document|documentation|dataset|data){_W}is{_W})?"
_TERMS = rf"{_W}under{_W}(?:the{_W}terms{_W}(?:and{_W}conditions{_W})?of{_W})?(?:(?:the|a|an){_W})?"
LEADS = (
    (rf"{_SUBJECT}licensed{_TERMS}", "licensed under "),
    (rf"{_SUBJECT}(?:released|distributed|available|made{_W}available|provided){_TERMS}", "under "),
)
