"""Fixed values. They must equal the published behaviour for results to be right."""

from __future__ import annotations

# --- fixed values: accepted header names per standard field, first hit wins -------------------------
HEADER_ALIASES = {
    "resume": ["resume", "resume_str", "resume_text", "cv", "cv_text"],
    "job_description": ["job_description", "jd", "job_desc", "description", "job_description_text"],
    "job_role": ["job_roles", "job_role", "role", "job_title", "position", "title"],
    "label": ["best_match", "label", "shortlisted", "recruiter_decision", "selected", "hired", "match"],
    "category": ["category", "resume_category"],
}
POSITIVE_LABELS = ["1", "yes", "y", "true", "hire", "hired", "selected", "shortlisted", "match", "best match"]
NEGATIVE_LABELS = ["0", "no", "n", "false", "reject", "rejected", "not selected", "no match"]
SENSITIVE_COLUMNS = ["age", "gender", "race", "ethnicity", "job_applicant_name", "name"]
UNAUDITED_COLUMNS = ["job_applicant_name", "name"]
UNKNOWN_ROLE = "Unknown"
MIN_SCREENING_CHARS = 20
MIN_CATEGORY_CHARS = 50

# --- fixed values: base skill list ------------------------------------------------------------------
BASE_SKILLS = [
    # programming and data
    "python", "java", "javascript", "typescript", "c++", "c#", "sql", "r programming", "scala", "golang",
    "ruby", "php", "html", "css", "react", "angular", "node.js", "django", "flask", "spring", "rest api",
    "machine learning", "deep learning", "nlp", "computer vision", "data analysis", "data science",
    "statistics", "pandas", "numpy", "scikit-learn", "tensorflow", "pytorch", "keras", "spark", "hadoop",
    "tableau", "power bi", "excel", "etl", "data visualization", "big data",
    # cloud and operations
    "aws", "azure", "gcp", "docker", "kubernetes", "jenkins", "git", "linux", "ci/cd", "terraform", "devops",
    "microservices", "networking", "cybersecurity", "network security",
    # business
    "project management", "agile", "scrum", "stakeholder management", "business analysis",
    "product management", "digital marketing", "seo", "content writing", "sales", "negotiation",
    "customer service", "accounting", "financial analysis", "budgeting", "auditing", "taxation",
    "recruitment", "talent acquisition", "payroll", "employee relations", "supply chain", "logistics",
    "operations management", "procurement", "crm", "sap", "erp",
    # personal
    "communication", "leadership", "teamwork", "problem solving", "time management", "critical thinking",
    "presentation", "mentoring",
    # health and other fields
    "patient care", "pharmacology", "nursing", "medical terminology", "healthcare", "nutrition", "teaching",
    "curriculum development", "graphic design", "ui/ux", "figma", "photoshop", "autocad",
    "mechanical design", "electrical engineering", "civil engineering",
]
FALLBACK_ROLE_SKILLS = ["communication", "problem solving"]

# --- fixed values: education levels, highest first, and their names ----------------------------------
EDUCATION_PATTERNS = [
    (4, r"\b(ph\.?d|doctorate|doctoral)\b"),
    (3, r"\b(master'?s?|mba|m\.?tech|m\.?sc|m\.?s\.?|m\.?e\.?|mca|post[- ]?graduate)\b"),
    (2, r"\b(bachelor'?s?|b\.?tech|b\.?sc|b\.?e\.?|b\.?com|bca|bba|graduate degree|undergraduate)\b"),
    (1, r"\b(diploma|associate degree)\b"),
    (0, r"\b(high school|secondary school|12th)\b"),
]
EDUCATION_NAMES = {0: "High school", 1: "Diploma", 2: "Bachelor's", 3: "Master's", 4: "PhD"}
EDUCATION_UNKNOWN = "Not stated"

# --- fixed values: seniority words and years, most junior first ---------------------------------------
SENIORITY_PATTERNS = [
    (r"\b(intern|fresher|entry[- ]level|graduate trainee)\b", 0.5),
    (r"\b(junior)\b", 1.5),
    (r"\b(mid[- ]level|intermediate)\b", 4.0),
    (r"\b(senior|sr\.)\b", 7.0),
    (r"\b(lead|principal|staff|head of|manager)\b", 9.0),
]
YEARS_PATTERN = r"(\d{1,2}(?:\.\d)?)\s*\+?\s*(?:years?|yrs?)"
MAX_YEARS = 45.0

# --- fixed values: certifications, sections, contact ---------------------------------------------------
CERTIFICATION_LIST_PATTERN = r"certifications? such as ([^.]+)"
CERTIFICATION_WORD_PATTERN = r"\b(certified|certification|certificate)\b"
SECTION_HEADERS = ["summary", "objective", "experience", "work history", "education", "skills", "projects",
                   "certifications", "achievements"]
CONTACT_PATTERN = r"\S+@\S+|\+?\d[\d\s-]{8,}"
SHORT_RESUME_WORDS = 80
FLAG_SHORT = "Very short resume - limited evidence"
FLAG_NO_SKILLS = "No recognisable skills found"
FLAG_NO_EDUCATION = "Education not stated"

# --- fixed values: phrases that introduce skills --------------------------------------------------------
SKILL_PHRASE_PATTERNS = [
    r"proficient in ([^.;\n]+?)(?:,? with |\.|;|\n|$)",
    r"skills?\s*[:\-]\s*([^.\n]+)",
    r"skilled in ([^.;\n]+?)(?:,? with |\.|;|\n|$)",
]
SKILL_LIST_SPLIT = r",| and |\|"

# --- fixed values: feature order ---------------------------------------------------------------------------
FEATURE_NAMES = [
    "tfidf_similarity", "skill_overlap", "skill_coverage", "skill_jaccard", "resume_skill_count",
    "jd_skill_count", "education_level", "required_education", "education_gap", "experience_years",
    "required_experience", "experience_gap", "certifications", "resume_word_count", "role_title_in_resume",
]

# --- fixed values: scoring -----------------------------------------------------------------------------------
WEIGHT_SKILLS = 0.45
WEIGHT_SEMANTIC = 0.30
WEIGHT_EDUCATION = 0.10
WEIGHT_EXPERIENCE = 0.15
SHORTLIST_AT = 65
HOLD_AT = 45
SHORTLIST_REASON = "strong overall fit with the job requirements"
HOLD_REASON = "partial fit; verify depth of experience"
REJECT_REASON = "low alignment with the core requirements"

# --- fixed values: interview panel ------------------------------------------------------------------------------
PANEL_LEVELS = {"Engineer": 1, "Senior": 2, "Lead": 3, "Manager": 4, "Director": 5}
PANEL_SIZE = 3

# --- fixed values: model training ----------------------------------------------------------------------------------
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
SHORTLIST_PROBABILITY = 0.5
MIN_GROUP_ROWS = 20
FOUR_FIFTHS = 0.8
MIN_CLASS_ROWS = 5

# --- fixed values: retrieval ------------------------------------------------------------------------------------------
CHUNK_CHARS = 700
CHUNK_OVERLAP = 120
TOP_K = 4
MIN_RETRIEVAL_SCORE = 0.05
NOT_FOUND = "I couldn't find this in the HR policies. Please contact HR."
PANEL_POLICY_QUESTION = ("How should the interview panel be formed and what must interviewers "
                         "do to ensure a fair, structured interview?")

# --- fixed values: prompt texts ---------------------------------------------------------------------------------------------
GUARD_TEXT = (
    "You assist recruiters. Base every statement only on the information provided. "
    "Never infer or mention age, gender, race, ethnicity, religion, marital status, disability "
    "or any other protected attribute. If information is missing, say so instead of guessing."
)
SUMMARY_SYSTEM = GUARD_TEXT + " Write concise, neutral, evidence-based candidate summaries."
SUMMARY_USER = """Job role: {role}

Job description:
{jd}

Candidate resume:
{resume}

Screening signals: match score {match_score}/100, ML shortlist probability {prob}, \
matched skills: {matched}, missing skills: {missing}.

Write a candidate summary for the hiring manager with these sections:
1. Profile (2 sentences)
2. Strengths for this role (3 bullets)
3. Gaps or risks to verify (2-3 bullets)
4. Recommendation (one line: Shortlist / Hold / Reject, with the main reason)"""
QUESTIONS_SYSTEM = GUARD_TEXT + " You design structured, job-related interview questions."
QUESTIONS_USER = """Job role: {role}
Job description:
{jd}

Candidate's matched skills: {matched}
Skills missing or unclear: {missing}
Candidate experience (approx. years): {exp}

Create {n} interview questions. Mix: technical (on matched skills), gap-probing (on missing skills),
behavioural, and role-specific scenario questions. Return ONLY a JSON array, each item:
{{"category": "...", "question": "...", "what_to_look_for": "..."}}"""
POLICY_SYSTEM = (
    "You are an HR policy assistant. Answer ONLY from the policy excerpts provided. "
    "Cite excerpts as [1], [2] etc. If the excerpts do not contain the answer, reply exactly: "
    "\"I couldn't find this in the HR policies. Please contact HR.\""
)
POLICY_USER = """Policy excerpts:
{context}

Question: {question}

Answer in 2-5 sentences with citations."""
RESUME_PROMPT_CHARS = 3500
QUESTION_PROMPT_CHARS = 2500

# --- fixed values: summary of an application ----------------------------------------------------------------------------
SUMMARY_PROFILE = "**Profile**"
SUMMARY_LEAD = "Candidate with about {years} years of experience (education: {education}) and {n} identifiable skills"
SUMMARY_CATEGORY = ", most aligned with {category}"
SUMMARY_STRENGTHS = "**Strengths for this role**"
SUMMARY_STRENGTH = "- Demonstrates {s}"
SUMMARY_NO_STRENGTH = "- No direct skill overlap detected"
SUMMARY_SIMILARITY = "- Semantic similarity to the JD: {percent}"
SUMMARY_GAPS = "**Gaps or risks to verify**"
SUMMARY_GAP = "- No evidence of {s}"
SUMMARY_NO_GAP = "- No major skill gaps detected"
SUMMARY_BEHIND = "- Experience is about {years} years below the stated requirement"
SUMMARY_ADVICE = "**Recommendation:** {decision} - {reason}"
SUMMARY_MOST_STRENGTHS = 5
SUMMARY_MOST_GAPS = 4

# --- fixed values: interview question bank ---------------------------------------------------------------------------------------
QUESTION_COUNT = 8
TECHNICAL_QUESTION = ("Walk us through a recent piece of work where you used {s}. "
                      "What was your specific contribution and what was the result?")
TECHNICAL_LOOK_FOR = "Concrete, first-hand detail about {s}; measurable outcome."
GAP_QUESTION = ("This role needs {s}. What exposure do you have to it, "
                "and how would you get up to speed in your first month?")
GAP_LOOK_FOR = "Honest self-assessment, adjacent experience, a realistic learning plan."
STANDARD_QUESTIONS = [
    ("Behavioural",
     "Tell us about a time you had to deliver under a tight deadline with incomplete information. "
     "What did you do?",
     "Prioritisation, communication with stakeholders, ownership."),
    ("Role scenario",
     "In your first 90 days as {role}, what would you focus on and how would you measure success?",
     "Understanding of the role, structured plan."),
    ("Behavioural",
     "Describe a disagreement with a teammate and how it was resolved.",
     "Collaboration, respect, focus on outcome over ego."),
    ("Motivation",
     "What draws you to {role}, and what do you want to learn next?",
     "Genuine alignment with the role and growth mindset."),
]

# English stop words of two letters or more (the whole-word entries of Spark's list).
STOP_WORDS = """
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were
be been being have has had having do does did doing an the and but if or because as until while of at by for
with about against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other some such no
nor not only own same so than too very can will just don should now cannot could ought would
""".split()
