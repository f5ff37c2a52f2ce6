"""Word lists, patterns and labels that results depend on."""

from __future__ import annotations

# English function words.
FUNCTION_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both "
    "but by can cannot could did do does doing down during each few for from further get got had has have having he "
    "her here hers herself him himself his how i if in into is it its itself me more most my myself no nor not of off "
    "on once only or other ought our ours ourselves out over own same she should so some such than that the their "
    "theirs them themselves then there these they this those through to too under until up upon us very was we were "
    "what when where which while who whom why will with would you your yours yourself yourselves"
).split()

# Filler words of work items.
FILLER_WORDS = (
    "also use used using just like new need make sure shall may must might able see set add one two three four five "
    "following based update create field record type user system data value name please note ensure per via within "
    "without however well still already currently include including included"
).split()

# More words that retrieval passes over.
RETRIEVAL_WORDS = (
    "find give tell write check look want know show help read atlassian browse https http www net com jira wiki org "
    "png jpg gif svg color image border width height style font background padding margin rgba"
).split()

# Left-overs of page markup and tracker exports, and developers' commonplaces.
EXPORT_WORDS = (
    "atlassian browse https http www net com jira wiki org png jpg gif svg jpeg bmp webp pdf csv xls xlsx doc docx ppt "
    "pptx zip tar color image border width height style font background padding margin rgba rgb hex solid none auto "
    "inherit transparent inline block flex grid display visibility overflow cursor pointer opacity transition transform "
    "div span class href src alt title rel target blank table thead tbody tfoot col colgroup caption story points "
    "sprint assignee reporter resolution closed done priority medium high low critical blocker created updated resolved "
    "confluence attachment thumbnail screenshot"
).split()
COMMONPLACE_WORDS = (
    "field record object page user system data value name list button click display show hide add remove update create "
    "delete edit save cancel submit select enter view form label input output component section header footer sidebar "
    "panel modal dialog popup tab menu dropdown checkbox radio toggle switch slider true false null undefined none empty "
    "blank error warning info debug log trace test testing tested verify verified check checked todo fixme hack "
    "workaround temporary api endpoint url uri path route method request response body payload config configuration "
    "setting option parameter argument"
).split()

#: Profiles of stop words by name.
STOP_WORDS = {
    "base": FUNCTION_WORDS + FILLER_WORDS,
    "export": FUNCTION_WORDS + FILLER_WORDS + EXPORT_WORDS + COMMONPLACE_WORDS,
    "retrieval": FUNCTION_WORDS + FILLER_WORDS + RETRIEVAL_WORDS,
}

# Capitals that aren't acronyms.
NOT_ACRONYMS = (
    "AND THE FOR NOT BUT ALL HAS HAD NEW OLD ADD GET SET PUT DEL ARE WAS HIS HER ITS OUR YOU WHO HOW WHY MAY CAN USE "
    "RUN TRY SAY SAW SEE LET DID END BIG TOP LOW MAX MIN AVG SUM YES TBD ETA FYI WIP EOD EOW FAQ DIY CEO CTO CFO COO CMO "
    "PDF CSV SQL XML API URL URI SSL TLS SSH FTP DNS CDN JWT PNG JPG GIF SVG CSS OTP MFA SSO VPN IDE GIT NPM PIP HTML "
    "JSON YAML TOML SOAP REST CRUD SOQL SOSL SFDX MDAPI TRUE NULL VOID ENUM ELSE ELIF CASE WHEN THEN FROM INTO WITH LIKE "
    "DESC LIMIT GROUP ORDER INNER OUTER LEFT RIGHT JOIN TODO NOTE EDIT COPY MOVE LINK SAVE LOAD OPEN CLOSE SEND WAIT HTTP "
    "OR AN IF IS IT AT BY DO GO IN ME MY NO OF ON SO TO UP WE AM AS BE HE ID OK US ONLY MUST WILL NEED ALSO EACH BOTH "
    "THAT THIS SAME TYPE UPON DOES NONE SOME MANY MOST SUCH VERY BEEN HAVE MAKE GIVE TAKE DONE HERE THEY WHAT WERE ONCE "
    "FULL PART"
).split()

# Words in -ing that name no process.
NOT_PROCESSES = (
    "using being having doing getting setting making taking giving looking working adding following including existing "
    "corresponding matching missing nothing something everything anything during string"
).split()

# Intents in their order, each with the patterns of which one is found.
INTENTS = {
    "story_lookup": [r"(?:explain|describe|what is|tell me about|understand)\s+(?:story\s+)?PR\d+", r"PR\d+-\d+", r"(?:story|stories|jira)\s+(?:for|in|about)"],
    "component_search": [r"(?:what|which|find|list)\s+(?:component|metadata|object|field|flow|trigger|class)", r"(?:component|metadata|trigger|flow|class|object)\s+(?:for|involved|related|used)", r"(?:impacted|affected|touched)\s+(?:component|metadata)"],
    "conflict_detection": [r"(?:conflict|overlap|clash|collision)", r"(?:cross.?sprint|between\s+sprint|sprint.?conflict)", r"(?:already.?built|previous.?sprint|existing)"],
    "test_planning": [r"(?:test|testing)\s+(?:scenario|case|plan|script|coverage)", r"(?:edge\s+case|negative\s+test|regression|UAT)", r"(?:AC\s+coverage|acceptance\s+criteria\s+test)"],
    "solution_design": [r"(?:technical\s+solution|design|approach|architecture)", r"(?:how\s+(?:to|should|would)\s+(?:implement|build|design))", r"(?:recommend|suggest|propose)\s+(?:solution|approach|pattern)"],
    "impact_analysis": [r"(?:impact|dependency|dependent|downstream|upstream)", r"(?:what\s+(?:is|are)\s+(?:affected|impacted|changed))", r"(?:regression\s+risk|side\s+effect)"],
    "knowledge_query": [r"(?:what\s+is|how\s+does|explain|describe)\s+(?!story|PR\d)", r"(?:tell\s+me\s+about|understand|clarify)"],
    "workspace_tooling": [r"(?:script|split|parse|index|analyze|corpus|RAG|token|semantic)", r"(?:template|workspace|cursor|rule|skill)"],
}

# Questions and their intents where nobody has asked any yet.
FALLBACK_QUERIES = [
    ("clinician onboarding platform event", "component_search"), ("client contracting agreement process", "knowledge_query"),
    ("facility agreement rate changes", "knowledge_query"), ("approval flow clinician contract", "component_search"),
    ("offboarding clinician platform event", "component_search"), ("HPF report email scheduling", "component_search"),
    ("UAT defects testing issues", "test_planning"), ("Agentforce agent configuration", "knowledge_query"),
]

# Words of labels, environments before processes.
ENVIRONMENT_WORDS = "uat prod qa smoke regression test hypercare".split()
PROCESS_WORDS = "onboarding offboarding contracting maintenance scheduling approval migration integration client provider clinician facility opportunity agreement termination".split()

# Platform terms of integrations, and words beside which they are looked for.
ECOSYSTEM_TERMS = "MuleSoft Heroku PlatformEvent ChangeDataCapture OutboundMessage RestAPI SoapAPI BulkAPI CompositeAPI StreamingAPI MetadataAPI ToolingAPI ConnectAPI NamedCredential ExternalService".split()
INTEGRATION_WORDS = "integration sync api webhook middleware inbound outbound callout endpoint service connector adapter bridge etl pipeline".split()

# Single words that say nothing as an object's name.
COMMON_OBJECT_WORDS = (
    "record action set item type role member status change request history link collection target lock part failed job "
    "batch user group plan setting score matrix map task event process template form rule alert message session instance "
    "version log error info result summary detail entry"
).split()

#: Names of components in questions.
COMPONENT_PATTERN = r"(?:Account|Contact|Opportunity|Lead|Case|Task|Flow|Trigger|ApexClass|ApexTrigger|LWC|Aura|HealthcareProvider|HealthcareFacility|Clinician|Provider|Client|Facility|Agreement|PlatformEvent|BatchJob|ScheduledJob|ValidationRule|ProcessBuilder|WorkflowRule)\w*"
#: Paths of files in questions.
PATH_PATTERN = r"(?i)(?:knowledge|artifacts|scripts)/[^\s\"'<>]+\.(?:md|html|py|json|yaml)"

# Acceptance criteria that say nothing.
EMPTY_CRITERIA = ["", "as per description", "see description", "refer to description"]

# Labels of metadata folders.
FOLDER_LABELS = {
    "objects": "Custom Objects & Fields", "flows": "Flows", "classes": "Apex Classes", "triggers": "Apex Triggers",
    "lwc": "Lightning Web Components", "aura": "Aura Components", "permissionsets": "Permission Sets",
    "permissionsetgroups": "Permission Set Groups", "profiles": "Profiles", "staticresources": "Static Resources",
    "applications": "Applications", "tabs": "Tabs", "labels": "Custom Labels", "layouts": "Page Layouts",
    "flexipages": "FlexiPages / Lightning Pages", "remoteSiteSettings": "Remote Site Settings",
    "namedCredentials": "Named Credentials", "platformEventChannels": "Platform Event Channels",
    "platformEventChannelMembers": "Platform Event Channel Members", "queues": "Queues", "groups": "Groups",
    "reports": "Reports", "dashboards": "Dashboards", "emailtemplates": "Email Templates",
    "customMetadata": "Custom Metadata Records", "globalValueSets": "Global Value Sets",
    "standardValueSets": "Standard Value Sets", "validationRules": "Validation Rules", "workflows": "Workflows",
    "duplicateRules": "Duplicate Rules", "matchingRules": "Matching Rules",
    "genAiPromptTemplates": "Agentforce: Prompt Templates", "genAiFunctions": "Agentforce: Functions",
    "genAiPlanners": "Agentforce: Planners", "bots": "Einstein Bots", "omniScripts": "OmniScripts",
    "omniIntegrationProcedures": "OmniStudio: Integration Procedures",
    "omniDataTransforms": "OmniStudio: DataRaptors", "omniUiCard": "OmniStudio: UI Cards",
}

# Sections and metadata keys of a story.
SECTIONS = ["Description", "Acceptance Criteria", "Solution", "Build Components", "Deployment Instructions", "Root Cause", "Linked Issues", "Sub-tasks"]
METADATA_KEYS = ["Sprint", "Status", "Type", "Priority", "Assignee", "Components", "Epic", "Labels"]

# Fields of an exported table by the exact class of their cells, and by hints in the class.
CELL_FIELDS = {
    "issuekey": "issue_key", "summary": "summary", "status": "status", "issuetype": "issue_type", "priority": "priority",
    "assignee": "assignee", "reporter": "reporter", "creator": "creator", "components": "components", "parent": "epic",
    "labels": "labels", "resolution": "resolution", "description": "description", "customfield_XXXXX": "acceptance_criteria",
    "customfield_YYYYY": "solution", "customfield_ZZZZZ": "build_components", "customfield_10035": "deployment_instructions",
    "customfield_10036": "epic_theme", "customfield_10047": "story_points", "customfield_10020": "sprint_name",
    "customfield_10300": "root_cause", "customfield_10301": "root_cause_type", "customfield_10038": "environment",
    "issuelinks": "linked_issues", "subtasks": "subtasks", "created": "created", "updated": "updated",
    "resolutiondate": "resolved",
}
CELL_HINTS = {
    "issue_key": ["issuekey"], "summary": ["summary"], "status": ["status"], "components": ["components", "component"],
    "ac": ["acceptance", "ac", "customfield_acceptance"], "solution": ["solution", "approach", "customfield_solution"],
    "story_points": ["storypoints", "story_points", "customfield_storypoints"], "sprint": ["sprint"],
    "assignee": ["assignee"], "priority": ["priority"],
}

# How personas, expansions of acronyms and processes are written.
PERSONA_PATTERN = r"[Aa]s\s+(?:a|an)\s+([A-Za-z][A-Za-z\s/\-]{2,40}?)(?:\s*[,.]|\s+(?:I|i|we|We)\s)"
NOT_PERSONAS = "user who|person who|member of"
EXPANDED_NAME = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,6}"
WORD_MARKS = r"^[,:;()\[\]\"']+|[,:;()\[\]\"']+$"

# Measures, their limits, and what is advised below or above them.
ADVICE = {
    "corpus": [
        ("ac_pct", "<", 70, "Acceptance Criteria: {ac_missing} % of the stories have none; fill in first: {ac_worst}"),
        ("solution_pct", "<", 60, "Solution: {solution_missing} % of the stories have none; fill in first: {solution_worst}"),
        ("mean_quality", "<", 60, "Mean quality is {mean_quality} of 100; start with the stories below 40"),
        ("missing", ">", 0, "{missing} components of stories have no document; write those first that most stories name"),
        ("sparse", ">", 0, "{sparse} stories have fewer than 500 bytes; fill them in or take them out"),
    ],
    "usage": [
        ("overall_rate", "<", 50, "{overall_rate} % of the input comes from the cache; longer sessions would raise it"),
        ("outliers", ">", 5, "{outliers} requests cost more than three times the mean of {cost_per_request}; look for large files in them"),
        ("daily", ">", 5, "A day costs {daily:.2f} on average; smaller files to read would lower it"),
    ],
    "queries": [
        ("general_pct", ">", 30, "{general_pct} % of the questions have no known intent; add patterns, or make their topics easier to find"),
        ("with_ids_pct", ">", 50, "{with_ids_pct} % of the questions name a story; keep criteria and solutions of every story full"),
        ("recurring", ">", 0, "Asked again and again: {phrases}; an index or a page of answers would help"),
    ],
    "retrieval": [
        ("mean_best", "<", 0.2, "The mean best match is {mean_best}; stories and questions use other words, so write the askers' words into the stories"),
        ("gaps_pct", ">", 30, "{gaps_pct} % of the questions have no good match; write documents for the topics among them that recur"),
        ("gap_terms", ">", 0, "Terms of questions without a match: {terms}"),
        ("no_match", ">", 5, "{no_match} questions match nothing at all; they may be about something else"),
        ("cost", ">", 1, "A request costs {cost:.2f} on average; reading single stories would lower it"),
    ],
}
#: What is said when no limit is passed.
NO_ADVICE = {"corpus": "Nothing critical is missing", "usage": "Usage looks sound", "queries": "Nothing critical in what is asked", "retrieval": "What is asked is covered"}
