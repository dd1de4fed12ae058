"""The labelled table of the licence scan: templates of licence families, other licence talk, ordinary text."""

# Notices and opening sentences of public licences, as they stand in files and pages.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Apache License Version 2.0, January 2004",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "lgpl-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction',
        "This project is licensed under the MIT License",
    ),
    "bsd-3-clause": (
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
    ),
    "bsd-2-clause": (
        "Licensed under the BSD 2-Clause License.",
        "The BSD 2-Clause License",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
    ),
    "mpl-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nc-nd-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "cc-by-nc-sa-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "cc-by-nd-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
}

# Word pairs that tell a family from its relatives: name, version and variant. A notice must have one pair of
# every group of its family.
DECIDING = {
    "apache-2.0": (("apache license",), ("2 0",)),
    "gpl-3.0": (("gnu general", "gnu gpl"), ("version 3", "v 3", "gpl 3")),
    "gpl-2.0": (("gnu general", "gnu gpl"), ("version 2", "v 2", "gpl 2")),
    "lgpl-3.0": (("lesser general",), ("version 3", "v 3")),
    "lgpl-2.1": (("lesser general",), ("2 1",)),
    "agpl-3.0": (("affero general",), ("version 3", "v 3")),
    "mit": (("mit license", "hereby granted"), ("mit license", "deal in")),
    "bsd-3-clause": (("3 clause", "neither the"),),
    "bsd-2-clause": (("2 clause",),),
    "isc": (("isc license", "without fee"),),
    "mpl-2.0": (("mozilla public",), ("2 0",)),
    "mpl-1.1": (("mozilla public",), ("1 1",)),
    "cc-by-nc-4.0": (("by nc", "attribution noncommercial"), ("nc 4", "noncommercial 4")),
    "cc-by-nc-nd-4.0": (("nc nd", "noncommercial noderivatives"), ("nd 4", "noderivatives 4")),
    "cc-by-nc-sa-4.0": (("nc sa", "noncommercial sharealike"), ("sa 4", "sharealike 4")),
    "cc-by-nd-4.0": (("by nd", "attribution noderivatives"), ("nd 4", "noderivatives 4")),
    "cc-by-4.0": (("by 4", "attribution 4"),),
    "cc-by-sa-4.0": (("by sa", "attribution sharealike"), ("sa 4", "sharealike 4")),
}

#: Licence talk of none of the families.
UNKNOWN = (
    "Licensed under the terms of our own agreement.",
    "This work is licensed under a licence of its own.",
    "Released under the terms stated by the author.",
    "All rights reserved. No part of this work may be reproduced without permission.",
    "Copyright by the authors. See the licence for details.",
    "You may not use this file without a written licence from the owner.",
    "Use is subject to the licence terms of the vendor.",
    "This software is proprietary and confidential.",
    "Redistribution is not permitted without consent.",
    "The software license agreement is between you and the company.",
    "Licensed under a commercial license, version 1.",
    "Released under an unnamed public license.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met",
)

#: Ordinary text that uses some of the same words.
ORDINARY = (
    "He renewed his driving license in April.",
    "The ship was released from the harbour after the storm.",
    "A general meeting of the public was held at noon.",
    "Version 3 of the story is shorter than version 2.",
    "The common people gave their work free of charge.",
    "She is a licensed electrician and works in the town.",
    "They found the source of the river and its binary form was unclear.",
    "Foundation work began in January 2004.",
    "The creative students share their commons room.",
    "Permission to speak was granted to any person in the hall.",
    "The Apache helicopter landed near the MIT campus.",
    "Conditions are met and the terms are fair.",
)

#: Words put before and after a template, so that its words are learnt and not its place.
SURROUNDINGS = (
    ("", ""),
    ("Note:", "See the file for details."),
    ("(c) 2020 the authors.", ""),
    ("", "All other text is by its authors."),
)
