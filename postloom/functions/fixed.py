"""Fixed values that results depend on: word lists, patterns, ranks and scores, in their natural order."""

ATS = ["ashby", "greenhouse", "lever", "bamboohr", "workday", "icims"]

# Ranks for choosing among duplicates; anything else ranks 99.
TIER_RANK = {"A": 1, "B": 2, "C": 3, "D": 4, "F": 5}
QUALITY_RANK = {"OK": 1, "REVIEW": 2, "BAD_ROW": 3}
REMOTE_RANK = {"Remote": 1, "Hybrid": 2, "Onsite": 3, "Unknown": 4}
ATS_RANK = {"ashby": 1, "greenhouse": 2, "lever": 3, "bamboohr": 4, "workday": 5, "icims": 6}

BUCKETS = ["STRONG_MATCH", "POSSIBLE_MATCH", "ADJACENT", "LOW_SIGNAL", "IGNORE_FOR_NOW"]
BUCKET_SCORE = {"STRONG_MATCH": 50, "POSSIBLE_MATCH": 30, "ADJACENT": 15, "LOW_SIGNAL": 5, "IGNORE_FOR_NOW": 0}
BUCKET_REASON = {"STRONG_MATCH": "Strong title match", "POSSIBLE_MATCH": "Possible title match", "ADJACENT": "Adjacent title signal", "LOW_SIGNAL": "Low title signal"}

# Title categories: patterns of a category, in the order in which categories are tried.
CATEGORY_PATTERNS = [
    ("Documentation Engineering", [r"\b(documentation|docs?)\s+(engineer|engineering|developer|architect|platform|systems?)\b", r"\bdeveloper documentation\b", r"\bapi documentation\b", r"\bdocs platform\b"]),
    ("Management / Leadership", [
        r"\b(head|director|manager|lead|principal)\b.*\b(technical publications|documentation|technical writing)\b",
        r"\b(technical publications|documentation|technical writing)\b.*\b(head|director|manager|lead|principal)\b",
    ]),
    ("Technical Writing", [
        r"\btechnical writers?\b", r"\btech writer\b", r"\btechnical author\b", r"\btechnical communicator\b", r"\btechnical publications?\b", r"\btechnical writing\b", r"\btechnical documentation\b",
        r"\bproduct engineering writer\b", r"\bdocumentation (specialist|writer|author|lead)\b", r"\binformation developer\b", r"\bproposal writer\b", r"\bsop technical writer\b",
    ]),
    ("Content Design / UX Writing", [
        r"\bux writer\b", r"\bcontent designer\b", r"\bproduct content designer\b", r"\bconversation designer\b", r"\bcontent design\b", r"\bproduct writer\b.*\bux\b", r"\bcontent architect\b",
    ]),
    ("Developer Relations", [
        r"\bdeveloper advocate\b", r"\bdeveloper relations\b", r"\bdevrel\b", r"\bdeveloper experience\b", r"\bdeveloper community\b", r"\bdeveloper advocacy\b", r"\bdeveloper ecosystem\b",
        r"\bdeveloper success\b", r"\bdeveloper events\b", r"\bdeveloper marketing\b", r"\bdeveloper (enablement|growth|conference)\b", r"\bcommunity developer\b",
    ]),
    ("Knowledge Management", [r"\bknowledge manager\b", r"\bknowledge management\b", r"\bknowledge base\b", r"\bknowledge content\b", r"\benablement manager\b"]),
    ("Technical Content", [
        r"\btechnical content\b", r"\bcontent engineer\b", r"\btechnical editor\b", r"\btechnical curriculum\b", r"\btechnical trainer\b", r"\btechnical courseware\b", r"\btechnical training\b",
        r"\btraining content developer\b", r"\blearning content developer\b", r"\bcurriculum content developer\b", r"\belearning content developer\b", r"\bassessment developer\b",
    ]),
    ("Content Writing", [
        r"\bcontent writer\b", r"\bcopywriter\b", r"\bwriter editor\b", r"\bcontent editor\b", r"\bseo content\b", r"\bcontent manager\b", r"\bmarketing content\b", r"\bcontent marketing\b",
        r"\bbranded content\b", r"\bsocial media content\b", r"\bcontent developer\b", r"\bwriter\s*(?:\/|and|&)\s*editor\b", r"\beditor\s*(?:\/|and|&)\s*writer\b", r"\bscript writer\b",
        r"\bwriter\b.*\beditor\b", r"\beditor\b.*\bwriter\b",
    ]),
    ("Management / Leadership", [
        r"\b(head|director|manager|lead|principal)\b.*\b(documentation|content|knowledge|developer experience|technical writing|technical writer)\b",
        r"\b(documentation|content|knowledge|developer experience|technical writing|technical writer)\b.*\b(head|director|manager|lead|principal)\b",
    ]),
    ("Adjacent Roles", [
        r"\btechnical product manager\b", r"\bproduct manager\b", r"\bsolutions architect\b", r"\bsolution architect\b", r"\bmember of technical staff\b", r"\bsoftware engineer\b", r"\bsearch engineer\b",
        r"\bclinical context engineer\b", r"\bai enablement engineer\b", r"\bcontext engineer\b", r"\btechnical developer\b", r"\btechnical consultant\b", r"\btechnical support\b",
        r"\btechnical program manager\b", r"\binformation (?:security )?architect\b", r"\binformation architecture\b", r"\bdocument specialist\b", r"\bdocument analyst\b", r"\bdeveloper\b",
        r"\bengineer\b", r"\barchitect\b", r"\btechnical\b",
    ]),
]

# Work arrangement: (signal, pattern), in order.
REMOTE_SIGNALS = [
    ("remote", r"\bremote\b"),
    ("remote us", r"\bremote\s*[-,]?\s*(us|u\.s\.|usa|united states)\b"),
    ("anywhere in the us", r"\banywhere in (the )?(us|u\.s\.|usa|united states)\b"),
    ("distributed", r"\bdistributed (team|company|workforce|organization|org)\b"),
    ("work from home", r"\bwork from home\b|\bwork-from-home\b"),
    ("hybrid", r"\bhybrid\b"),
    ("office days", r"\boffice days\b|\bin-office\b|\bin office\b|\bonsite days\b"),
    ("onsite", r"\bonsite\b|\bon-site\b|\boffice-based\b"),
    ("must be located in", r"\bmust be located in\b"),
    ("based in", r"\bbased in\b"),
]
COUNTRY_SIGNALS = [
    ("United States", r"\bunited states\b|\bu\.s\.\b|\busa\b"),
    ("North America", r"\bnorth america\b"),
    ("Americas", r"\bamericas\b"),
    ("Canada", r"\bcanada\b"),
    ("United Kingdom", r"\bunited kingdom\b|\buk\b"),
    ("Europe/EMEA", r"\beurope\b|\beu\b|\bemea\b"),
    ("India", r"\bindia\b|\bbengaluru\b|\bbangalore\b|\bdelhi\b|\bmumbai\b"),
    ("APAC", r"\baustralia\b|\bnew zealand\b|\bapac\b|\bsingapore\b|\bjapan\b"),
]

# Pay ranges: the second pattern is tried if the first finds nothing.
SALARY_PATTERNS = [
    r"(?i)(\$)\s*([0-9]{2,3}(?:,[0-9]{3})+|[0-9]{2,3})(k?)\s*(?:-|–|—|to)\s*\$?\s*([0-9]{2,3}(?:,[0-9]{3})+|[0-9]{2,3})(k?)",
    r"(?i)(\$)\s*([0-9]+)(k)\s*(?:-|–|—|to)\s*\$?\s*([0-9]+)(k)",
]

# Title tokens.
STRONG_TOKENS = "documentation docs developer api knowledge ux information publications publishing education enablement dita content technical writing writer editor author architect communicator toolsmith".split()
WEAK_TOKENS = "senior sr staff principal lead manager director head vp vice president specialist analyst coordinator experienced".split()
PAIRED_ONLY_TOKENS = ["content", "technical", "writer", "writing"]
ADJACENT_TOKENS = "content knowledge education ux enablement publishing publications information documentation docs technical".split()
DOMAIN_PHRASES = [
    "documentation", "docs", "technical writing", "technical writer", "developer documentation", "api", "knowledge", "knowledge base", "content design", "ux writing", "technical publications",
    "publications", "publishing", "enablement", "product education", "information architecture", "information experience", "dita", "docs-as-code", "docops",
]
SENIORITY = ["senior", "sr", "staff", "principal", "lead", "head", "director", "vp", "vice president", "manager"]
LEADERSHIP = ["manager", "director", "head", "vp", "vice president", "lead"]
IC = ["writer", "author", "editor", "engineer", "specialist", "developer", "architect", "communicator", "toolsmith", "designer"]
ROLE_TOKENS = [*LEADERSHIP, *IC, "writing", "documentation", "docs", "publications", "publishing"]

# The watchlist: titles of a category.
WATCHLIST = [
    ("Documentation", [
        "Technical Writer", "Technical Writing Lead", "Senior Technical Writer", "Principal Technical Writer", "Director of Documentation", "VP of Documentation", "Head of Documentation",
        "Documentation Manager", "Documentation Engineer", "Documentation Specialist", "Documentation Consultant", "Content Designer", "UX Writer", "Information Architect", "Knowledge Base Specialist",
    ]),
    ("Developer Education & Enablement", [
        "Developer Advocate", "Developer Experience Engineer", "DevRel Engineer", "Developer Education Manager", "Developer Marketing Lead", "Developer Evangelist", "Community Education Lead",
        "Product Education Manager",
    ]),
    ("Related Publications & Knowledge", ["Technical Publisher", "Publications Editor", "Knowledge Manager", "Knowledge Base Architect", "Documentation Ops Specialist"]),
]

# Phrases of the fit score.
SCORE_DOMAINS = [
    "documentation", "docs", "technical writing", "technical writer", "developer documentation", "api", "knowledge", "knowledge base", "content design", "ux writing", "technical publications",
    "information architecture", "product education", "enablement", "dita", "docops",
]
NON_WRITER = [
    "software engineer", "backend engineer", "frontend engineer", "full stack engineer", "full-stack engineer", "data engineer", "infrastructure engineer", "security engineer", "cloud engineer",
    "devops engineer", "platform engineer", "product engineer", "mobile developer", "backend developer", "frontend developer", "full stack developer", "software developer", "web developer",
    "wordpress developer", "rpa developer", "member of technical staff", "technical support engineer", "support engineer", "solutions architect", "solution architect", "cloud architect",
    "data architect", "ai architect", "infrastructure architect", "systems architect", "enterprise architect", "customer success architect", "business systems architect", "therapist", "nurse",
    "clinical", "video editor", "film editor", "motion graphics", "game developer", "game designer", "product designer", "ux designer",
]
WRITER_DOC = [
    "technical writer", "technical writing", "documentation", "docs", "docops", "documentation engineer", "developer documentation", "api documentation", "content writer", "technical content",
    "content designer", "ux writer", "information architect", "information architecture", "knowledge manager", "knowledge base", "technical publications", "product education", "enablement content",
    "developer advocate", "developer relations", "devrel",
]
WRITER_DOC_DEVREL = ["developer advocate", "developer relations", "devrel"]
DEVREL_TITLE = ["developer advocate", "developer relations", "devrel", "developer marketing", "developer content"]
DEVREL_EVIDENCE = ["content", "docs", "documentation", "writing", "community", "education", "tutorials", "guides", "examples", "enablement"]
DOCS_EVIDENCE = [
    "documentation", "docs", "technical writing", "writing", "content", "enablement", "education", "knowledge base", "tutorials", "guides", "developer relations", "developer advocacy",
    "developer advocate", "devrel",
]
WRITER_EXCEPTION = [
    "documentation engineer", "product documentation engineer", "technical content engineer", "documentation specialist", "technical documentation specialist", "technical writer",
    "staff technical writer", "ux writer", "content writer", "content designer", "developer documentation", "api documentation", "developer advocate", "developer relations", "devrel",
]
TITLE_FLOOR = [
    "technical writer", "technical writing", "staff technical writer", "documentation engineer", "product documentation engineer", "documentation specialist", "technical documentation specialist",
    "developer documentation", "api documentation", "content writer", "technical content", "content designer", "ux writer", "knowledge manager", "technical publications",
]
SEVERE_NON_WRITER = [
    "therapist", "nurse", "clinical", "software engineer", "backend engineer", "frontend engineer", "full stack engineer", "full-stack engineer", "data engineer", "security engineer",
    "devops engineer", "platform engineer", "product engineer", "member of technical staff",
]

# The second generation of title rules: tokens, keywords in their order, and domains.
CORE_STRONG = ["writer", "writing", "editor", "edit", "docs", "doc", "docusaurus", "documentation", "technical", "technical-writing"]
CORE_WEAK = ["developer", "devops", "content", "author", "product", "engineering", "program", "manager", "specialist"]
CORE_LEADERSHIP = ["head of", "vp of", "director of", "vice president", "chief", "executive", "principal", "senior director", "distinguished", "fellows"]
CORE_IC = ["lead", "senior", "principal", "staff", "engineer", "writer", "editor", "architect", "consultant", "specialist"]
CORE_SENIORITY = ["lead", "senior", "principal", "staff", "director", "vp", "chief", "executive", "distinguished"]
CORE_DOMAINS = [
    ("Documentation/Content", ["writer", "writing"]), ("Developer Relations", ["developer advocate", "devrel"]), ("Developer Education", ["education", "enablement"]), ("Knowledge Management", ["knowledge", "publishing"]),
]

# Titles with these don't match a watchlist title without them, though they contain it.
MARKETING = ["content marketing", "demand generation", "growth marketing", "marketing content", "product marketing", "social media"]
VARIANTS = {"sr": "senior", "tech": "technical"}

# Where boards are shown, the keys that an entry's value and address are looked for under, and titles that are noise.
BOARD_URLS = {"ashby": "https://jobs.ashbyhq.com/", "lever": "https://jobs.lever.co/", "greenhouse": "https://job-boards.greenhouse.io/"}
ENTRY_VALUES = ["slug", "company", "name", "id", "url", "careerSiteUrl", "careersUrl"]
ENTRY_URLS = ["url", "careerSiteUrl", "careersUrl"]
TITLE_NOISE = [
    "technical recruiter", "clinical documentation", "medical documentation", "risk adjustment", "hcc documentation", "loan documentation", "mortgage loan", "legal document", "document specialist",
    "controlled substance", "ocean freight", "technical developer", "software developer", "developer productivity", "developer experience", "information security", "security architect",
    "content marketing", "technical content marketing", "seo", "social media", "content licensing", "content partnerships", "content creator", "developer events", "developer platform partnership",
    "technical product marketing",
]
