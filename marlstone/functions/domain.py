"""Relevance patterns and word lists as configuration: the professional field is data, not code."""

from __future__ import annotations

# Stems and phrases of the field; each is matched as written, without case.
RELEVANT = (
    r"\btooth\b", r"\bteeth\b", r"\bdent\w*\b", r"\bgingiv\w*\b", r"\bperiodont\w*\b", r"\bendodont\w*\b", r"\borthodont\w*\b",
    r"\bprosthodont\w*\b", r"\bpedodont\w*\b", r"\bperidont\w*\b", r"\bocclus\w*\b", r"\bmalocclus\w*\b", r"\bcari(?:es|ous)\b",
    r"\bcavit(?:y|ies)\b", r"\benamel\b", r"\bdentin\b", r"\bpulpitis\b", r"\bgingivitis\b", r"\bperiodontitis\b", r"\babscess\b",
    r"\bplaque\b", r"\btartar\b", r"\bcalculus\b", r"\bcrown\b", r"\bbridge\b", r"\bdenture\b", r"\bveneer\b", r"\bimplant\b",
    r"\bfilling\b", r"\bextraction\b", r"\broot canal\b", r"\bscaling\b", r"\bortho(?:dontic|brace|aligner)\w*\b", r"\bbraces\b",
    r"\baligner\b", r"\binvisalign\b", r"\bmolar\b", r"\bpremolar\b", r"\bincisor\b", r"\bcanine tooth\b", r"\bwisdom (?:tooth|teeth)\b",
    r"\bmandib\w*\b", r"\bmaxill\w*\b", r"\bocclusion\b", r"\bbite\b", r"\btmj\b", r"\btemporomandibular\b",
    r"\bdental (?:caries|implant|hygien\w*|surgery|crown|abscess|pain|exam|filling|cavity|plaque|prosthesis|fluorosis|trauma|emergency|sealant|x-ray|radiograph|cyst|fluoride)\b",
    r"\boral (?:health|hygiene|cancer|surgery|medicine|pathology|cavity|mucosa|lesion|ulcer|biopsy|examination|prosthesis|leukoplakia|lichen planus|candidiasis|thrush|appliance|disease)\b",
    r"\bmouth (?:ulcer|sore|cancer|disease|breath)\b", r"\bgum (?:disease|graft|recession|bleeding|infection|swelling)\b",
    r"\bjaw (?:pain|surgery|fracture|joint)\b", r"\bbruxism\b", r"\bxerostomia\b", r"\bhalitosis\b", r"\bsialadenitis\b",
    r"\bcleft (?:lip|palate)\b", r"\bdry mouth\b", r"\btoothache\b", r"\bfluorid\w*\b", r"\bdent(?:ist|istry|alschool)\b",
)
# Parts of subject headings of the field.
HEADINGS = (
    "dentistry", "tooth", "teeth", "dental", "gingiv", "periodont", "endodont", "orthodont", "prosthodont", "oral surg",
    "stomatognath", "mouth", "oral", "caries", "plaque", "calculus", "occlus", "malocclus", "pulpitis", "pulp dis", "periapic",
    "tmj", "temporomand", "implant", "denture", "crown", "veneer", "cleft lip", "cleft palate", "salivary", "xerostom",
    "leukoplakia", "lichen planus", "oral candid", "mouth neop", "tongue", "fluoros", "fluorid", "bruxism", "halitos", "gingival",
    "maxillofac", "jaw",
)
# Whole words and phrases of the field, as two sources list them.
WHOLE_WORDS = (
    "dent(?:al|ist|in|ition|ure)", "tooth", "teeth", "molar", "premolar", "incisor", "canine", "oral", "gingiv", "periodon", "endodon",
    "orthodon", "prosthodon", "pulp(?:itis|ectomy|otomy)", "caries", "cavity", "crown", "bridge", "implant", "extraction", "root canal",
    "mandib", "maxill", "alveol", "occlus", "malocclu", "bruxism", "fluoride", "plaque", "tartar", "calculus", "scaling", "apical",
    "periapical", "abscess", "fistula", "granuloma", "amalgam", "composite", "ceramic", "zirconia", "tmj", "temporomandibular",
    "stomatitis", "glossitis", "leukoplakia", "erythroplakia", "lichen planus", "salivary", "parotid", "sublingual", "submandibular",
    "cleft lip", "cleft palate", "oral surgery", "oral pathol", "dental material", "dental cement", "dental anest", "trigeminal",
    "inferior alveolar nerve", "lingual nerve",
)
# The same for abstracts.
ABSTRACT_WORDS = (
    "dent(?:al|ist|in|ition|ure)", "tooth", "teeth", "molar", "premolar", "incisor", "canine teeth",
    "oral (?:health|cavity|mucosa|cancer|surgery|hygiene|pathol)", "gingiv", "periodon", "endodon", "orthodon", "prosthodon",
    "pulp(?:itis|ectomy|otomy)", "caries", "dental crown", "dental bridge", "dental implant", "extraction", "root canal", "mandib",
    "maxill", "alveol", "occlus", "malocclu", "bruxism", "fluoride", "plaque", "tartar", "calculus", "scaling", "amalgam",
    "composite resin", "ceramic", "zirconia", "tmj", "temporomandibular", "stomatitis", "glossitis", "leukoplakia", "erythroplakia",
    "oral lichen", "salivary gland", "parotid", "cleft (?:lip|palate)",
)
# Words without content, terms of front matter, and questions about a book instead of its matter.
STOPWORDS = (
    "a an the and or but if then so as of in on at to from by with for is are was were be been being have has had do does did this "
    "that these those it its their there which who whom what when where why how about into over under between among also can could "
    "should would may might must shall will not no yes more less very much many such all any each every some both either neither"
).split()
FRONT_MATTER = (
    "isbn|copyright|publisher|reproduced|reproduction|leaflet|manufacturer|acknowledg(?:ement|ments?)|dedication|disclaimer|cataloging|"
    "preface|foreword|trademark|imprint|edited by|edition|reprint|distributors?|library of congress|all rights reserved|illustrator|"
    "translator|contributors?|about the authors?|biographical|registered"
)
META_QUESTIONS = (
    "according to (the )?(text|passage|textbook|atlas|author|chapter|section)|"
    "what does the (text|passage|textbook|author|atlas|chapter|section)|"
    "how (is|are) .{0,40} (organized|presented|structured|arranged) (in|within|throughout)|"
    "what (specific )?information is provided in|what is described in this (section|chapter|passage|text)|page numbers? pp?\\.|"
    "the (text|passage|atlas|textbook|author) (states|describes|covers|outlines|explains)"
)
