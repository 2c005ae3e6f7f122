"""Wording of well-known licences and of the notices that name them.

Licences that are pages long stand here by the notice that their own text asks
for, which their files hold as well.
"""

from __future__ import annotations

_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC_END = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_GNU_END = "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
_WEB = "along with this program. If not, see <https://www.gnu.org/licenses/>."


def _gnu(thing: str, name: str, version: str) -> str:
    return f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} {_GNU_END} {name} for more details. You should have received a copy of the {name} {_WEB}"


TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _AS_IS
        + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. " + _AS_IS,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program " + _GNU_END + " GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    ),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", _gnu("program", "GNU General Public License", "3")),
    "LGPL-2.1": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library " + _GNU_END + " GNU Lesser General Public License for more details.",
    ),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", _gnu("library", "GNU Lesser General Public License", "3")),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", _gnu("program", "GNU Affero General Public License", "3")),
    "GFDL-1.3": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.",),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", f"{_BSD} {_BSD_END}"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", f"{_BSD} {_BSD_NAME} {_BSD_END}", f"{_BSD} {_BSD_NAME}"),
    "ISC": (
        "Licensed under the ISC License.",
        f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "0BSD": (f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_ISC_END}",),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "EUPL-1.2": ("Licensed under the EUPL, Version 1.2.", "Licensed under the European Union Public Licence 1.2."),
    "CDDL-1.0": ("The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License.",),
    "Artistic-2.0": ("Licensed under the Artistic License 2.0.", "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",),
    "Zlib": (
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    "PostgreSQL": ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",),
    "PSF-2.0": ("Licensed under the Python Software Foundation License Version 2.",),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.",),
    "WTFPL": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "CC0-1.0": (
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "ODbL-1.0": ("This database is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/. Any rights in individual contents of the database are licensed under the Database Contents License.",),
    "proprietary": ("All rights reserved.", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",),
}

#: The six licences of one family differ by these parts of their names.
_PARTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
for _code in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    _name = "-".join(_PARTS[p] for p in _code.split("-"))
    for _version, _kind in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES[f"CC-{_code}-{_version}"] = (
            f"Licensed under CC {_code} {_version}.",
            f"This work is licensed under a Creative Commons {_name} {_version} {_kind} License.",
            f"This work is licensed under CC {_code} {_version}. To view a copy of this license, visit https://creativecommons.org/licenses/{_code.lower()}/{_version}/",
        )
