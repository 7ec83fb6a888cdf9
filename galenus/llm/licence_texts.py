"""Licence templates: texts that licences publish for the head of a file, whole short licences, and the opening of long ones.

Each is (identifier, text, phrases that a notice must hold whatever its score: name and version).
"""

from __future__ import annotations

# Public licence texts.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TERMS = (
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License."
)
_APACHE_OPENING = "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."


def _gnu(name: str, program: str, version: str, warranty: str = "GNU General Public License") -> str:
    """The notice that the licences of this family ask for."""
    return (
        f"{program} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"{program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {warranty} for more details."
    )


def _opening(name: str, version: str, day: str, years: str) -> str:
    """How the licences of this family begin."""
    return f"{name} Version {version}, {day} Copyright (C) {years} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"

TEMPLATES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("AGPL-3.0", _gnu(_AGPL, "This program", "3", _AGPL), ("affero general", "version 3")),
    ("AGPL-3.0", _opening(_AGPL, "3", "19 November 2007", "2007"), ("affero general", "version 3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license", "version 2", "2 0")),
    ("Apache-2.0", _APACHE, ("apache license", "version 2", "2 0")),
    ("Apache-2.0", _APACHE_OPENING, ("apache license", "version 2", "2 0")),
    ("BSD", _BSD_HEAD, ("redistribution and",)),
    ("BSD-2-Clause", "This work is licensed under the BSD 2-Clause License.", ("bsd 2", "2 clause")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TERMS + _BSD_DISCLAIMER, ("redistribution and",)),
    ("BSD-3-Clause", "This work is licensed under the BSD 3-Clause License.", ("bsd 3", "3 clause")),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER, ("redistribution and", "endorse or", "promote products")),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", ("by 4", "4 0")),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("attribution 4", "4 0")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("nc 4", "4 0")),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ("noncommercial 4", "4 0")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("sa 4", "4 0")),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ("sharealike 4", "4 0")),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0.", ("cc0 1", "1 0")),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ("neighboring rights",)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu general", "version 2")),
    ("GPL-2.0", _gnu(_GPL, "This program", "2"), ("gnu general", "version 2")),
    ("GPL-2.0", _opening(_GPL, "2", "June 1991", "1989, 1991"), ("gnu general", "version 2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu general", "version 3")),
    ("GPL-3.0", _gnu(_GPL, "This program", "3"), ("gnu general", "version 3")),
    ("GPL-3.0", _opening(_GPL, "3", "29 June 2007", "2007"), ("gnu general", "version 3")),
    ("ISC", _ISC, ("permission notice",)),
    ("LGPL-2.1", _gnu(_LGPL, "This library", "2.1", _LGPL), ("lesser general", "version 2", "2 1")),
    ("LGPL-2.1", _opening(_LGPL, "2.1", "February 1999", "1991, 1999"), ("lesser general", "version 2", "2 1")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", ("lesser general", "version 3")),
    ("LGPL-3.0", _gnu(_LGPL, "This library", "3", _LGPL), ("lesser general", "version 3")),
    ("LGPL-3.0", _opening(_LGPL, "3", "29 June 2007", "2007"), ("lesser general", "version 3")),
    ("MIT", "Released under the MIT License.", ("mit license",)),
    ("MIT", _MIT, ("permission notice",)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", ("mozilla public", "2 0")),
    ("MPL-2.0", _MPL, ("mozilla public", "2 0")),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ("unencumbered software",)),
    ("Unlicense", _UNLICENSE, ("unencumbered software",)),
    ("Zlib", _ZLIB, ("altered source",)),
)
