"""Fixed values.

Everything in this module is a constant that must equal the behaviour being
reproduced (word lists, lookup tables, patterns, thresholds).  They are kept
together, in their natural order, as plain data.  The operators compile them
into Spark column expressions or small rule DataFrames.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Field extraction
# --------------------------------------------------------------------------

# Degree markers tested as case-insensitive substrings, in priority order.
# The trailing blanks of "MA " and "BA " are part of the marker; the
# returned label is the marker without surrounding blanks.
DEGREE_MARKERS = [
    "PhD", "DPhil", "MSc", "MRes", "MBA", "MEng", "MPhil",
    "MA ", "BSc", "BEng", "BA ", "BBA", "LLB", "LLM",
    "MBChB", "BDS", "MArch",
]

# Level keywords over (level selector text + page title), lower-cased.
LEVEL_POSTGRADUATE_WORDS = ["postgraduate", "masters", "msc"]
LEVEL_UNDERGRADUATE_WORDS = ["undergraduate", "bsc", "ba "]
LEVEL_RESEARCH_WORDS = ["phd", "doctorate", "research"]

# Fee keywords, tried in order before the generic first-pound-amount scan.
FEE_UK_KEYWORDS = ["uk", "home", "domestic", "home/eu"]
FEE_INTL_KEYWORDS = ["international", "overseas", "intl"]
FEE_SANDWICH_KEYWORDS = ["sandwich", "placement year"]

MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]

# Max characters kept by the first-match helper per field.
DEFAULT_MAX_CHARS = 500
DESCRIPTION_MAX_CHARS = 5000
ENTRY_REQUIREMENTS_MAX_CHARS = 3000
DEADLINE_LATE_MAX_CHARS = 100

# --------------------------------------------------------------------------
# normalisation
# --------------------------------------------------------------------------

# Degree dictionary, in its insertion order (first contained key wins in the
# literal rule).  Dotted keys can never match once dots are stripped.
DEGREE_NORMALISATION = [
    ("bsc", "BSc"), ("b.sc", "BSc"),
    ("ba", "BA"), ("b.a", "BA"),
    ("beng", "BEng"), ("b.eng", "BEng"),
    ("msc", "MSc"), ("m.sc", "MSc"),
    ("mres", "MRes"),
    ("mphil", "MPhil"),
    ("meng", "MEng"),
    ("mba", "MBA"),
    ("phd", "PhD"), ("ph.d", "PhD"), ("dphil", "DPhil"),
    ("llb", "LLB"), ("llm", "LLM"),
    ("mbchb", "MBChB"), ("bds", "BDS"),
]
DEGREE_RAW_MAX_CHARS = 20

LEVEL_NORMALISATION = [
    ("ug", "undergraduate"), ("undergraduate", "undergraduate"),
    ("pg", "postgraduate"), ("postgraduate", "postgraduate"),
    ("masters", "postgraduate"),
    ("research", "research"), ("doctoral", "research"),
]

# Fallback flag: count of missing core fields that triggers gap filling.
FALLBACK_CORE_FIELDS = ["name", "degree", "fee_uk_yearly", "fee_intl_yearly",
                        "entry_requirements", "description"]
FALLBACK_THRESHOLD = 4

DEFAULT_STUDY_MODE = "full-time"
CURRENCY = "GBP"

# --------------------------------------------------------------------------
# validation
# --------------------------------------------------------------------------

BLOCKED_NAMES = [
    "contact", "contact us", "about", "about us", "privacy", "cookie",
    "cookies", "terms", "accessibility", "news", "events", "home", "apply",
    "open day",
]
BLOCKED_URL_TOKENS = [
    "/contact", "/about", "/news", "/event", "/events", "/privacy",
    "/cookie", "/cookies", "/terms", "/accessibility", "/help", "/support",
]
MIN_NAME_LENGTH = 3

# --------------------------------------------------------------------------
# Catalogue queries
# --------------------------------------------------------------------------

PAGE_SIZE_DEFAULT = 20
PAGE_SIZE_MAX = 100
UNKNOWN_UNIVERSITY = "Unknown"
NO_LOCATION = "N/A"
FILE_NAME_BAD_CHARS = r'[<>:"/\\|?*]'

# --------------------------------------------------------------------------
# Full-text search (english stop words of the text-search
# dictionary; tokens in this list are not indexed)
# --------------------------------------------------------------------------

ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "her", "hers", "herself", "it", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing",
    "a", "an", "the", "and", "but", "if", "or", "because", "as", "until",
    "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now",
]
SEARCH_WEIGHTS = [("name", "A"), ("department", "B"), ("degree", "C")]

# --------------------------------------------------------------------------
# Selector rules per field, in priority order.  Each rule is the
# CSS selector it stands for plus its structured form:
#   tag        element name              id          id attribute equals
#   class_eq   class token equals        class_like  class attribute contains
#   attr       attribute present         ancestor_class  some ancestor has class token
#   dt         "dt:contains(X) + dd"     has_h2      has an h2 descendant containing X
# --------------------------------------------------------------------------

SELECTOR_RULES = {
    "name": [
        ("h1.course-title", {"tag": "h1", "class_eq": "course-title"}),
        ("h1[class*='course']", {"tag": "h1", "class_like": "course"}),
        ("h1[class*='title']", {"tag": "h1", "class_like": "title"}),
        ("#course-name", {"id": "course-name"}),
        (".programme-header h1", {"tag": "h1", "ancestor_class": "programme-header"}),
        ("h1", {"tag": "h1"}),
    ],
    "degree": [
        (".course-type", {"class_eq": "course-type"}),
        (".qualification", {"class_eq": "qualification"}),
        ("[class*='award']", {"class_like": "award"}),
        (".degree-type", {"class_eq": "degree-type"}),
        (".programme-type", {"class_eq": "programme-type"}),
    ],
    "level": [
        (".study-level", {"class_eq": "study-level"}),
        (".programme-level", {"class_eq": "programme-level"}),
        ("[class*='level']", {"class_like": "level"}),
    ],
    "department": [
        (".department", {"class_eq": "department"}),
        (".faculty", {"class_eq": "faculty"}),
        ("[class*='department']", {"class_like": "department"}),
        ("[class*='faculty']", {"class_like": "faculty"}),
        (".school-name", {"class_eq": "school-name"}),
        ("[class*='school']", {"class_like": "school"}),
    ],
    "ucas_code": [
        (".ucas-code", {"class_eq": "ucas-code"}),
        ("[class*='ucas']", {"class_like": "ucas"}),
        ("[data-ucas]", {"attr": "data-ucas"}),
        ("dt:contains('UCAS') + dd", {"dt": "UCAS"}),
    ],
    "study_mode": [
        (".study-mode", {"class_eq": "study-mode"}),
        ("[class*='study-mode']", {"class_like": "study-mode"}),
        ("[class*='mode-of-study']", {"class_like": "mode-of-study"}),
    ],
    "duration": [
        (".duration", {"class_eq": "duration"}),
        ("[class*='duration']", {"class_like": "duration"}),
        ("[class*='length']", {"class_like": "length"}),
        ("dt:contains('Duration') + dd", {"dt": "Duration"}),
        ("dt:contains('Length') + dd", {"dt": "Length"}),
    ],
    "start_month": [
        ("[class*='start']", {"class_like": "start"}),
        ("[class*='intake']", {"class_like": "intake"}),
        ("dt:contains('Start') + dd", {"dt": "Start"}),
    ],
    "deadline_main": [
        ("[class*='deadline']", {"class_like": "deadline"}),
        ("[class*='closing']", {"class_like": "closing"}),
        ("dt:contains('Application') + dd", {"dt": "Application"}),
        ("dt:contains('Deadline') + dd", {"dt": "Deadline"}),
    ],
    "description": [
        (".course-description", {"class_eq": "course-description"}),
        (".course-overview", {"class_eq": "course-overview"}),
        ("#overview", {"id": "overview"}),
        ("[class*='description']", {"class_like": "description"}),
        ("[class*='overview']", {"class_like": "overview"}),
        (".intro-text", {"class_eq": "intro-text"}),
    ],
    "entry_requirements": [
        ("#entry-requirements", {"id": "entry-requirements"}),
        (".entry-requirements", {"class_eq": "entry-requirements"}),
        ("[class*='entry-req']", {"class_like": "entry-req"}),
        ("[class*='requirements']", {"class_like": "requirements"}),
        ("section:has(h2:contains('Entry'))", {"tag": "section", "has_h2": "Entry"}),
    ],
}
META_NAME_KEYS = ["og:title", "twitter:title"]
META_UCAS_KEY = "programme:ucas_code"
META_DURATION_KEY = "programme:duration"

# --------------------------------------------------------------------------
# Link discovery rules, one entry per source.  Keys:
#   selectors      anchors kept (union); each is a dict of
#                  href_contains / href_prefix / class_eq / anc_tag / anc_class;
#                  None = every <a href>
#   href_any       keep an href containing any of these (after the selectors)
#   drop_schemes   drop empty, tel:, mailto:, javascript: and '#' hrefs
#   includes       keep an href containing any of these
#   excludes       drop an href containing any of these (tested before resolving)
#   abs_contains   the resolved URL must contain this
#   abs_plain      the resolved URL must have no '?' and no '#'
#   abs_any        the resolved URL must contain one of these
#   canonical      cut the resolved URL at '#' and strip trailing '/'
#   exclude_self   drop the page's own URL (trailing '/' ignored)
#   exclude_start  drop any start URL of the source (trailing '/' ignored)
#   href_not       drop an href equal to this
#   url_patterns   second strategy unioned in: every href containing all of
#                  ``all`` and any of ``any``
#   dedup          keep the first occurrence of each resolved URL per page
# --------------------------------------------------------------------------

SOURCE_RULES = [
    {"source": "brookes", "university_name": "Oxford Brookes University",
     "location": "Oxford, England",
     "selectors": [{"href_contains": "/course/"}, {"href_contains": "/courses/"},
                   {"class_eq": "course-link"}, {"anc_tag": "div", "anc_class": "course-item"},
                   {"anc_tag": "li", "anc_class": "course-listing"}],
     "href_any": ["/course/", "/courses/"], "dedup": True},
    {"source": "loughborough", "university_name": "Loughborough University",
     "location": "Loughborough, England",
     "selectors": [{"href_contains": "/courses/"}, {"href_contains": "/masters-"},
                   {"class_eq": "course-link"}, {"anc_tag": "div", "anc_class": "course-item"},
                   {"anc_tag": "li", "anc_class": "course-listing"}, {"class_eq": "list__link"}],
     "href_any": ["/courses/", "/masters-"], "dedup": True},
    {"source": "lsbu", "university_name": "London South Bank University",
     "location": "London, England", "drop_schemes": True,
     "includes": ["/course/", "/courses/", "/study/course", "course-finder/", "undergraduate/",
                  "postgraduate/", "masters-courses/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#"], "dedup": True},
    {"source": "malvern_house", "university_name": "Malvern House International",
     "location": "London, England", "drop_schemes": True,
     "includes": ["/our-courses/", "/course/", "/courses/", "teacher-training",
                  "year-round-groups", "international-foundation-year", "international-year-one",
                  "international-master", "pre-masters", "ncuk"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#", "login", "agent-login"], "dedup": True},
    {"source": "middlesex", "university_name": "Middlesex University",
     "location": "London, England",
     "selectors": [{"href_contains": "/courses/", "anc_tag": "main"}],
     "drop_schemes": True, "abs_contains": "/courses/", "exclude_self": True, "abs_plain": True,
     "abs_any": ["/courses/undergraduate/", "/courses/postgraduate/",
                 "/courses/short-courses-and-cpd/", "/courses/foundation/",
                 "/courses/research-degrees/"], "dedup": True},
    {"source": "northeastern", "university_name": "Northeastern University London",
     "location": "London, England", "drop_schemes": True,
     "includes": ["/degrees/undergraduate/", "/degrees/postgraduate/",
                  "/degrees/degree-apprenticeships/", "/study/degrees/", "nulondon.ac.uk/degrees/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#"], "dedup": True},
    {"source": "northumbria", "university_name": "Northumbria University",
     "location": "Newcastle, England", "drop_schemes": True,
     "includes": ["/study-at-northumbria/courses/", "/courses/",
                  "northumbria.ac.uk/study-at-northumbria/courses/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#", "coming-to-northumbria", "postgraduate-study"], "dedup": True},
    {"source": "norwich", "university_name": "Norwich University of the Arts",
     "location": "Norwich, England", "drop_schemes": True,
     "includes": ["/courses/find-your-course/", "norwichuni.ac.uk/courses/", "/courses/postgraduate/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#", "find-your-course/", "postgraduate/", "grid-9404="],
     "dedup": True},
    {"source": "ntu", "university_name": "Nottingham Trent University",
     "location": "Nottingham, England",
     "selectors": [{"href_contains": "/course/"}, {"href_contains": "/courses/"},
                   {"class_eq": "course-link"}, {"anc_tag": "div", "anc_class": "course-item"},
                   {"anc_tag": "li", "anc_class": "course-listing"}],
     "href_any": ["/course/", "/courses/"], "dedup": True},
    {"source": "oieg", "university_name": "Oxford International Education Group",
     "location": "Multiple (UK)", "drop_schemes": True,
     "includes": ["/courses/detail/", "/courses/?", "/partner/", "/pathway-courses/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#", "for-students", "for-agents", "for-partners", "legal-policies"],
     "dedup": True},
    {"source": "qub", "university_name": "Queen's University Belfast",
     "location": "Belfast, Northern Ireland",
     "selectors": [{"href_contains": "/courses/undergraduate/"},
                   {"href_contains": "/courses/postgraduate-taught/"},
                   {"href_contains": "/courses/postgraduate-research/"},
                   {"class_eq": "course-link"}, {"class_eq": "course-title"},
                   {"anc_tag": "div", "anc_class": "course-item"},
                   {"anc_tag": "div", "anc_class": "course-card"},
                   {"anc_tag": "div", "anc_class": "course-listing"},
                   {"anc_tag": "li", "anc_class": "course"}],
     "url_patterns": {"all": ["/courses/"], "any": ["/undergraduate/", "/postgraduate-"]},
     "dedup": True},
    {"source": "ravensbourne", "university_name": "Ravensbourne University London",
     "location": "London, England", "selectors": [{"class_eq": "aspect-ratio-card"}],
     "dedup": False},
    {"source": "regent_college", "university_name": "Regent College London",
     "location": "London, England", "drop_schemes": True,
     "includes": ["/courses/detail/", "/courses/subjects/", "/courses/search/", "rcl.ac.uk/courses/"],
     "excludes": ["?query=", "?collection=", "?profile=", "?f.Level", "page=", "#", "subjects/", "search/"], "dedup": True},
    {"source": "regents_uni", "university_name": "Regent's University London",
     "location": "London, England", "selectors": [{"anc_tag": "main"}], "canonical": True,
     "abs_any": ["/undergraduate/", "/postgraduate/", "/foundation/", "/english/courses/"],
     "exclude_start": True, "dedup": True},
    {"source": "rgu", "university_name": "Robert Gordon University", "location": "Aberdeen, Scotland",
     "selectors": [{"class_eq": "link", "href_contains": "/study/courses/"}], "dedup": False},
    {"source": "richmond", "university_name": "Richmond American University London",
     "location": "London, England", "selectors": [{"class_eq": "programme-title"}], "dedup": False},
    {"source": "royal_holloway_isc", "university_name": "Royal Holloway ISC (Study Group)",
     "location": "Egham, England", "selectors": [{"href_prefix": "/programmes/"}],
     "href_not": "/programmes", "dedup": False},
    {"source": "st_georges", "university_name": "St George's, University of London",
     "location": "London, England", "drop_schemes": True,
     "includes": [
         "/prospective-students/courses/", "/courses/", "/undergraduate/", "/postgraduate/",
         "/foundation/", "/short-courses/", "/study/", "citystgeorges.ac.uk/courses",
         "citystgeorges.ac.uk/prospective-students/courses", "bayes.citystgeorges.ac.uk/study/",
         "bayes.city.ac.uk/study/", "/study/undergraduate/courses/", "/study/postgraduate/courses/",
         "/study/masters/courses/", "/study/mba/courses/", "/study/phd/courses/",
         "/study/executive-education/courses/", "technology.online.city.ac.uk/", "/course/",
         "/programme/", "/degree/", "/bachelor", "/master", "/phd", "/mba", "/msc", "/ba",
         "/bsc", "/beng", "/ma", "/march", "/llm", "/pgdip", "/pgcert", "/md", "/nursing",
         "/medicine", "/health", "/biomedical", "/paramedic", "/radiography", "/physiotherapy",
         "/psychology", "/sport", "/clinical", "/midwifery", "/therapeutic", "/diagnostic",
         "/rehabilitation", "/computer-science", "/data-science", "/cyber-security",
         "/artificial-intelligence", "/informatics", "/technology", "/business", "/law",
         "/finance", "/economics", "/management", "/marketing", "/actuarial", "/biology",
         "/chemistry", "/physics", "/mathematics", "/statistics", "/genetics", "/microbiology",
         "/sociology", "/anthropology", "/geography", "/history", "/philosophy", "/politics",
         "/international-relations"],
     "excludes": [
         "?query=", "?collection=", "?profile=", "?f.Level", "page=", "#",
         "courses", "prospective-students/courses", "prospective-students/courses/undergraduate",
         "prospective-students/courses/postgraduate", "/apply/how-to-apply", "/about/schools/",
         "/barrister-pathway", "/academic-programmes/", "/information-for-parents-and-carers",
         "/pupillage-advisory-service", "/bar-training", "/msc-nursing-rpl", "/research/",
         "?meta_level_sand=", "?meta_subject_sand="],
     "dedup": True},
]
UNSAFE_HREF_SCHEMES = ["tel:", "mailto:", "javascript:", "#"]
PARTNER_PREFIX = "OIEG - "
PARTNER_LOGO_CLASS = "course-partner-logo"
BLOCKED_STATUS = 403
