"""Fixed values.

These lists, patterns and labels define the file formats and the reporting
vocabulary.  They are data, kept in their natural order: results depend on
them being exactly these values.
"""

# --- file names and extensions (fixed values) -------------------------------
MANIFEST_NAME = "imsmanifest.xml"
JUNK_PARTS = ("__MACOSX", ".git", ".github", ".pytest_cache", "__pycache__", ".DS_Store")

CORE_FILES_INVENTORY = (
    "imsmanifest.xml", "questiondb.xml", "rubrics_d2l.xml", "grades_d2l.xml",
    "dropbox_d2l.xml", "checklist_d2l.xml", "conditionalrelease_d2l.xml",
    "intelligentagents_d2l.xml",
)
CORE_FILES_SCOPE = (
    "imsmanifest.xml", "grades_d2l.xml", "rubrics_d2l.xml", "dropbox_d2l.xml",
    "checklist_d2l.xml", "questiondb.xml", "orgunitconfig.xml",
)
CORE_PREFIXES = ("quiz_d2l_", "discussion_d2l")
XML_SUFFIXES = ("xml",)
HTML_SUFFIXES_INVENTORY = ("html", "htm")
HTML_SUFFIXES_SCOPE = ("html", "htm", "xhtml")
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "gif", "svg", "webp", "bmp")
MEDIA_SUFFIXES = ("mp4", "mov", "avi", "m4v", "webm", "mp3", "wav")
DOCUMENT_SUFFIXES = ("pdf", "doc", "docx", "ppt", "pptx", "xls", "xlsx", "csv", "txt", "qmd", "rmd")
FRONTEND_SUFFIXES = ("css", "js", "json")
PAGE_SUFFIXES = (".html", ".htm", ".xhtml", ".txt", ".md", ".markdown")

EXPECTED_COMPONENTS = ("imsmanifest.xml", "grades_d2l.xml", "dropbox_d2l.xml", "discussion_d2l_*.xml")

# --- link and markup patterns (fixed values) --------------------------------
NON_LOCAL_PREFIXES = ("http://", "https://", "data:", "mailto:", "javascript:", "tel:", "#", "//")
ACTIVITY_CODE = r"r[Cc]ode=([A-Za-z0-9._-]+)"
QUICKLINK_TYPE = r"[?&]type=([A-Za-z]+)"
EXPORT_NAME = r"(?i)D2LExport_(\d+)_(.+?)_(\d{8,14})(?:_|$|\.)"
EXTERNAL_URL = r"""(?i)https?://[^\s"'<>]+"""
WEEKISH = r"(?i)\b(week|module|unit)\s*0*(\d{1,2})\b"
PLACEHOLDER_PATTERNS = (r"\[insert[^\]]*\]", r"\bTBD\b", r"\bTODO\b", "PLACEHOLDER", "lorem ipsum")
SAMPLE_BYTES = 8192
HTML_SNIFF_BYTES = 1024
DUPLICATE_MIN_CHARS = 160
DUPLICATE_MIN_TOKENS = 20
DUPLICATE_OVERLAP = 0.92

QUICKLINK_KINDS = {
    "quiz": "quiz_link",
    "dropbox": "dropbox_link",
    "discuss": "discussion_link",
    "checklist": "checklist_link",
    "survey": "survey_link",
    "lti": "lti_link",
    "selfassess": "selfassessment_link",
    "content": "content_link",
}
NODE_LABELS = {
    "module": "module",
    "html_topic": "HTML content page",
    "content_file": "course file",
    "dropbox_link": "assignment link",
    "quiz_link": "quiz link",
    "discussion_link": "discussion link",
    "checklist_link": "checklist link",
    "survey_link": "survey link",
    "lti_link": "LTI/external tool link",
    "selfassessment_link": "self-assessment link",
    "content_link": "content quicklink",
    "quicklink": "quicklink",
}
CONDITION_TARGETS = (
    "quiz", "dropbox", "grade_object", "group", "discussion", "content_topic", "checklist", "survey",
)

# --- heading vocabulary (fixed values) --------------------------------------
CHECKLIST_WORDS = ("checklist",)
PRACTICE_WORDS = ("practice", "self-assessment", "self assessment", "self-check", "self check")
OBJECTIVE_WORDS = (
    "objective", "learning outcome", "outcomes", "goals", "students will be able", "swbat", "competenc",
)
ASSESSMENT_WORDS = ("quiz", "midterm", "assessment", "cumulative")
EXAM_PATTERN = r"\bexam(s|ination|inations)?\b"
RESOURCE_WORDS = (
    "reading", "resource", "material", "multimedia", "media", "video", "watch", "listen",
    "textbook", "reference", "required", "optional", "explore",
)
LESSON_WORDS = ("lesson", "lecture")
OVERVIEW_WORDS = (
    "overview", "introduction", "welcome", "start here", "intro", "orientation", "independent research",
)
INTRODUCTION_WORDS = ("course introduction", "welcome", "start here", "course overview", "introduction")
BARE_OVERVIEW_LABELS = ("overview", "introduction", "welcome", "start here")

FRONT_MATTER_TITLE_WORDS = {
    "course_description": ("course description", "catalog description", "description"),
    "required_materials": ("textbook", "required materials", "course materials", "materials for this course"),
    "course_learning_outcomes": ("course learning outcomes", "course outcomes"),
    "course_introduction": INTRODUCTION_WORDS,
}
FRONT_MATTER_HEADING_WORDS = {
    "course_description": ("course description", "catalog description", "description"),
    "required_materials": (
        "textbook", "required materials", "course materials", "materials for this course", "required texts",
    ),
    "course_learning_outcomes": (
        "course learning outcomes", "course outcomes", "student learning outcomes",
        "learning objectives and outcomes",
    ),
    "course_introduction": ("course introduction",),
}

# --- HTML block vocabulary (fixed values) -----------------------------------
BREAK_TAGS = (
    "p", "div", "br", "h5", "h6", "blockquote", "figure", "figcaption", "tr", "table", "section", "article",
)
BREAK_END_TAGS = (
    "p", "div", "li", "h5", "h6", "blockquote", "figure", "figcaption", "table", "tr", "section",
    "article", "summary",
)
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)
ARTIFACT_TEXTS = ("basic page - no banner", "basic page", "no banner", "banner", "blank page")
VIDEO_HOSTS = ("youtube.com", "youtu.be", "vimeo.com", "kaltura", "mediasite", "panopto")
VISUAL_TAGS = ("aside", "article", "blockquote", "details", "div", "figure", "section", "table")
VISUAL_LABELS = (
    ("d2l-callout-title", "Callout"),
    ("accordion", "Accordion"),
    ("project-callout", "Project callout"),
    ("assessment-callout", "Assessment callout"),
    ("discussion-note", "Discussion note"),
    ("roleplay-callout", "Roleplay callout"),
    ("survey-callout", "Survey callout"),
    ("side-quest", "Side quest"),
    ("next-step", "Next step"),
    ("case-card", "Case card"),
    ("info-card", "Information card"),
    ("timeline-card", "Timeline card"),
    ("timeline-item", "Timeline item"),
    ("timeline", "Timeline"),
    ("slide-card", "Slide card"),
    ("launch-card", "Launch card"),
    ("prototype-card", "Prototype card"),
    ("resources-section", "Resources section"),
    ("details-grid", "Details grid"),
    ("callout", "Callout"),
    ("note", "Note"),
    ("panel", "Panel"),
)
QUIET_VISUAL_LABELS = ("Timeline item", "Timeline card")
VISUAL_EXCLUDED = (
    "mceNonEditable", "placeholder", "d2l-practice", "practice-card", "practice-item",
    "practice-stage", "practice-header", "practice-meta", "practice-shell", "practice-cluster",
    "practice-wrapper", "practice-side-quest", "side-quest-content", "side-quest-practice-card",
    "side-quest-practice-stack", "video-wrap", "video-shell", "back-top",
)
PRACTICE_HOST = "practices.lcs.brightspace.com"
PRACTICE_TYPES = {
    0: "Sorting",
    1: "Sequencing",
    2: "Hotspot",
    3: "Quick quiz",
    4: "Quick quiz - legacy dropdown",
    5: "Quick quiz - single choice",
    6: "Quick quiz - multi-select",
    7: "Quick quiz - fill-in-the-blank",
}

# --- run vocabulary (fixed values) ------------------------------------------
CORE_STEPS = (
    "Establish source identity",
    "Inventory export files",
    "Probe manifest",
    "Reconstruct course structure",
    "Extract course activities",
)
STEP_TIMEOUT_SECONDS = 900
