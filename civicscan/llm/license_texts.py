"""Notices and typical passages of licence families, and texts that only look like them."""

# Licence wording, by family.
TEMPLATES: dict[str, list[str]] = {
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Released under the AGPL-3.0 license.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under CC-BY-4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Content is available under CC-BY-NC-4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Content is available under CC-BY-SA-3.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal.",
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GPL-3.0 license.",
        "Licensed under GPLv2 or later.",
        "Licensed under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL-2.1 license.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying or redistribution is prohibited.",
    ],
    "unknown": [
        "Licensed under the Example Community License.",
        "This work is licensed under terms available from its author.",
        "Released under the Sample Public License, version 1.",
        "See the LICENSE file for the licensing terms.",
        "Copyright holders grant a license to use this work.",
        "The content is licensed for use by members.",
        "Licensed under the Data Sharing License, version 1.2.",
        "SPDX-License-Identifier: LicenseRef-Custom",
    ],
    "none": [
        "He lost his driving licence on the way to the town.",
        "The restaurant applied for a liquor license last spring.",
        "The lecture on copyright law was cancelled.",
        "The table was reserved for six people.",
        "All the seats in the hall were reserved by Monday.",
        "They issued a fishing license to the visitor.",
        "The judge signed a warrant for the search.",
        "Old songs pass into the public domain after many years.",
        "A licensed plumber came to fix the sink.",
        "The car comes with a five year warranty.",
        "Doctors need a license to practice in the country.",
        "The plan would redistribute income to poorer regions.",
        "She asked about copyright and permission at the library.",
        "Rights of way are reserved for walkers.",
    ],
}
