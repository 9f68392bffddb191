"""Sentences by which public licences are known, and the rules over their identifiers.

The texts are those of the licences and of their usual notices. A rule names a licence
and the identifiers that make it, in order; earlier rules take their identifiers first.
"""

SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-title": ("The MIT License", "MIT License", "The MIT License (MIT)"),
    "mit-notice": (
        "Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
        "Distributed under the MIT License", "Use of this source code is governed by an MIT-style license", "License: MIT",
    ),
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    "as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ),
    "apache-title": ("Apache License, Version 2.0", "Apache License Version 2.0, January 2004"),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "This project is licensed under the Apache License 2.0", "Licensed under the Apache License 2.0",
    ),
    "apache-copy": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",),
    "gpl2-notice": (
        "This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published "
        "by the Free Software Foundation",
    ),
    "gpl2-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version",
    ),
    "gpl3-notice": (
        "This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License, version 3", "This project is licensed under the GNU General Public License v3.0",
    ),
    "gpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE",
    ),
    "gpl-copy": ("See the GNU General Public License for more details",),
    "lgpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "lgpl21-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    ),
    "agpl3-notice": ("Licensed under the GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3"),
    "agpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "bsd-use": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution",
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
    ),
    "bsd2-notice": ("Released under the BSD 2-Clause License", "Licensed under the BSD 2-Clause License"),
    "bsd3-notice": ("Released under the BSD 3-Clause License", "Licensed under the BSD 3-Clause License"),
    "bsd-style": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies",
    ),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    ),
    "boost-notice": ("Distributed under the Boost Software License, Version 1.0",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "cc0-notice": ("Licensed under CC0 1.0", "This work is licensed under CC0 1.0", "To the extent possible under law, the author has waived all copyright"),
    "cc-by-notice": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-notice": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc-notice": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-nd-notice": ("Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "cc-by-nc-sa-notice": ("Licensed under CC BY-NC-SA 4.0",),
    "spdx-mit": ("SPDX-License-Identifier: MIT",),
    "spdx-apache": ("SPDX-License-Identifier: Apache-2.0",),
    "spdx-gpl2": ("SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0"),
    "spdx-gpl3": ("SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0"),
    "spdx-bsd3": ("SPDX-License-Identifier: BSD-3-Clause",),
    "reserved": ("All rights reserved",),
}

RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-title", "mit-grant", "as-is")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "as-is")),
    ("ISC", ("isc-grant", "as-is")),
    ("Apache-2.0", ("apache-notice", "apache-copy")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("AGPL-3.0-only", ("agpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("spdx-gpl2",)),
    ("GPL-3.0-only", ("spdx-gpl3",)),
    ("MIT", ("spdx-mit",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-title",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-title",)),
    ("BSD-2-Clause", ("bsd2-notice",)),
    ("BSD-3-Clause", ("bsd3-notice",)),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("BSD-3-Clause", ("bsd-style",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("BSL-1.0", ("boost-notice",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("proprietary", ("reserved",)),
)
