"""How licences name themselves and what their notices say.

Short licences (MIT, BSD, ISC, Unlicense) stand whole, sentence by sentence;
of long ones the heading, the notice that files bear, and phrases of their own.
Those that follow a rule (GNU notices, licence identifiers, Creative Commons) are made by it.
"""

from __future__ import annotations

# The texts of the licences.
TEXTS = {
    "mit": [
        "MIT License",
        "The MIT License (MIT)",
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "apache": [
        "Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "gpl": [
        "GNU General Public License",
        "GNU General Public License Version 3, 29 June 2007",
        "GNU General Public License Version 2, June 1991",
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "lgpl": [
        "GNU Lesser General Public License",
        "GNU Lesser General Public License Version 3, 29 June 2007",
        "GNU Lesser General Public License Version 2.1, February 1999",
        "GNU Library General Public License",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "agpl": [
        "GNU Affero General Public License",
        "GNU Affero General Public License Version 3, 19 November 2007",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "mpl": [
        "Mozilla Public License Version 2.0",
        "Mozilla Public License, version 1.1",
        "Licensed under the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "bsd": [
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY",
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "isc": [
        "ISC License",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS",
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "unlicense": [
        "The Unlicense",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ],
    "public-domain": [
        "This work is dedicated to the public domain.",
        "Creative Commons CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}

# The notice of the GNU licences, for a program or a library.
GNU = {"gpl": "General Public License", "lgpl": "Lesser General Public License", "agpl": "Affero General Public License"}
GNU_NOTICE = [
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation.",
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.",
    "You should have received a copy of the GNU {name} along with this {what}. If not, see http://www.gnu.org/licenses/",
]

# The Creative Commons licences, their names, and the identifiers of the others.
CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
IDENTIFIERS = {
    "mit": ["MIT"],
    "apache": ["Apache-2.0"],
    "gpl": ["GPL-2.0-or-later", "GPL-3.0-only"],
    "lgpl": ["LGPL-2.1-or-later", "LGPL-3.0-only"],
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "mpl": ["MPL-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "isc": ["ISC"],
    "unlicense": ["Unlicense"],
    "public-domain": ["CC0-1.0"],
    **{f"cc-{code.lower()}": [f"CC-{code}-4.0"] for code in CREATIVE_COMMONS},
}


def templates() -> dict[str, list[str]]:
    """family -> its templates."""
    commons = {
        f"cc-{code.lower()}": [
            f"Licensed under CC {code} 4.0.",
            f"This work is licensed under a Creative Commons {name} 4.0 International License.",
            f"Creative Commons {name}",
        ]
        for code, name in CREATIVE_COMMONS.items()
    }
    gnu = {f: [line.format(what=what, name=name) for what in ("program", "library") for line in GNU_NOTICE] for f, name in GNU.items()}
    tags = {family: [f"SPDX-License-Identifier: {tag}" for tag in own] for family, own in IDENTIFIERS.items()}
    return {family: own + gnu.get(family, []) + tags.get(family, []) for family, own in (TEXTS | commons).items()}
