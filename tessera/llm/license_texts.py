"""License statements and notices looked for, in the wording of their publishers and in usual wordings. A license
may have several."""

TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software"),
    ("bsd-3-clause-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mit", "Distributed under the MIT License."),
    ("mit", "is licensed under the MIT License"),
    ("mit", "under the terms of the MIT license"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2.0", "Apache License Version 2.0, January 2004"),
    ("apache-2.0", "is licensed under the Apache License 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd-2-clause", "Licensed under the BSD 2-Clause License"),
    ("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd-3-clause-notice", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission"),
    ("bsd-disclaimer", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
     "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose "
     "are disclaimed"),
    ("mit-disclaimer", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
     "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("gpl-2.0", "GNU General Public License Version 2, June 1991"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("gpl-2.0-notice", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
     "version."),
    ("gpl-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("lgpl-2.1", "GNU Lesser General Public License Version 2.1"),
    ("lgpl-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("lgpl-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("lgpl-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("agpl-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("mpl-2.0", "Mozilla Public License Version 2.0"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("epl-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("cc-by-sa-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0"),
)
