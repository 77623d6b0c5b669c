"""A small course package rebuilt from the published sample numbers: 30 files, 25 items, two weeks."""

from __future__ import annotations

import os
import zipfile

Q = "/d2l/common/dialogs/quickLink/quickLink.d2l?type={}&amp;rCode={}"
PAGES = {  # resource, item id, title, href
    "RES_COURSE_INTRO": ("P0A", "Course Introduction", "pages/course-introduction.html"), "RES_COURSE_DESCRIPTION": ("P0B", "Course Description", "pages/course-description.html"),
    "RES_COURSE_MATERIALS": ("P0C", "Course Materials", "pages/course-materials.html"), "RES_COURSE_OUTCOMES": ("P0D", "Course Learning Outcomes", "pages/course-outcomes.html"),
    "RES_PROJECT_ROADMAP": ("P0E", "Project Roadmap and Setup", "pages/project-roadmap.html"),
    "RES_W1_OVERVIEW": ("P1", "Week 1 Overview", "pages/week1-overview.html"), "RES_W1_OBJECTIVES": ("P2", "Week 1 Learning Objectives", "pages/week1-objectives.html"),
    "RES_W1_MATERIALS": ("P3", "Week 1 Learning Materials and Resources", "pages/week1-materials.html"), "RES_W1_CASE_PACKET": ("P4", "Case Packet PDF", "files/week1-case-packet.pdf"),
    "RES_W1_SCENARIO": ("P5", "Scenario Lab", "pages/week1-scenario-lab.html"), "RES_W2_COMBINED": ("P6", "Week 2 Overview and Learning Materials", "pages/week2-overview-materials.html"),
    "RES_W2_PRACTICE": ("P7", "Week 2 Practice and Reflection", "pages/week2-practice.html"), "RES_HIDDEN_FILE": ("HF1", "Instructor Notes Draft", "files/hidden-instructor-notes.docx"),
    "RES_HIDDEN_PAGE": ("HP2", "Hidden Faculty Setup Page", "pages/hidden-faculty-setup.html"),
}
TOOLS = {
    "RES_DROPBOX_A1": ("A1", "Planning Memo", "dropbox", "CODE-A1"), "RES_DROPBOX_A2": ("A2", "Data Snapshot Worksheet", "dropbox", "CODE-A2"), "RES_DROPBOX_A3": ("A3", "Reflection Journal", "dropbox", "CODE-A3"),
    "RES_QUIZ_Q1": ("Q1", "Readiness Quiz", "quiz", "CODE-Q1"), "RES_HIDDEN_QUIZ": ("HQ1", "Draft Quiz - Hidden", "quiz", "CODE-QH"), "RES_DISCUSS_D1": ("D1", "Planning Assumptions Discussion", "discuss", "CODE-D1"),
    "RES_DISCUSS_D2": ("D2", "Peer Reply Discussion", "discuss", "CODE-D2"), "RES_CHECKLIST_C1": ("C1", "Week 1 Checklist", "checklist", "CODE-CL1"),
}
MODULES = {
    "M0": ("RES_MOD0", "Getting Started", ["RES_COURSE_INTRO", "RES_COURSE_DESCRIPTION", "RES_COURSE_MATERIALS", "RES_COURSE_OUTCOMES", "RES_PROJECT_ROADMAP"]),
    "M1": ("RES_MOD1", "Week 1", ["RES_W1_OVERVIEW", "RES_W1_OBJECTIVES", "RES_W1_MATERIALS", "RES_W1_CASE_PACKET", "RES_W1_SCENARIO", "RES_DROPBOX_A1", "RES_DROPBOX_A2", "RES_QUIZ_Q1", "RES_DISCUSS_D1", "RES_DISCUSS_D2", "RES_CHECKLIST_C1", "RES_HIDDEN_QUIZ", "RES_HIDDEN_FILE"]),
    "M2": ("RES_MOD2", "Week 2", ["RES_W2_COMBINED", "RES_W2_PRACTICE", "RES_DROPBOX_A3", "RES_HIDDEN_PAGE"]),
}
HIDDEN = {"RES_HIDDEN_QUIZ", "RES_HIDDEN_FILE", "RES_HIDDEN_PAGE"}
GRADES = [("G1", "Planning Memo", "20"), ("G2", "Data Snapshot Worksheet", "10"), ("G3", "Reflection Journal", "8"), ("G4", "Peer Review", "5"), ("G5", "Planning Discussion", "10"), ("G6", "Reply Discussion", "5"), ("G7", "Readiness Quiz", "10.000000000"), ("G8", "Standalone Participation", "5")]


def manifest() -> str:
    out = ['<?xml version="1.0" encoding="UTF-8"?><manifest xmlns:d2l_2p0="urn:d2l"><organizations><organization>']
    for mid, (res, title, kids) in MODULES.items():
        out.append(f'<item identifier="{mid}" identifierref="{res}"><title>{title}</title>')
        for kid in kids:
            name = (PAGES.get(kid) or TOOLS[kid])[:2]
            flag = ' isvisible="False"' if kid in HIDDEN else ""
            out.append(f'<item identifier="{name[0]}" identifierref="{kid}"{flag}><title>{name[1]}</title></item>')
        out.append("</item>")
    out.append("</organization></organizations><resources>")
    out += [f'<resource identifier="{m[0]}" type="webcontent" d2l_2p0:material_type="contentmodule"/>' for m in MODULES.values()]
    out += [f'<resource identifier="{k}" type="webcontent" d2l_2p0:material_type="content" href="{v[2]}"/>' for k, v in PAGES.items()]
    out += [f'<resource identifier="{k}" type="webcontent" d2l_2p0:material_type="contentlink" href="{Q.format(v[2], v[3])}"/>' for k, v in TOOLS.items()]
    return "".join(out) + "</resources></manifest>"


def files() -> dict[str, str]:
    page = "<html><head><title>{0}</title></head><body><h1>{0}</h1><p>About {0} &amp; more.</p></body></html>"
    out = {v[2]: page.format(v[1]) for v in PAGES.values() if v[2].endswith(".html")}
    out["pages/week1-overview.html"] = '<h1>Overview</h1><p>Hi</p><img src="../assets/planning-cycle.png" alt="Cycle"><img src="../assets/equation-screenshot.png"><h2>Readings</h2><p>Read <a href="https://example.org/a">this</a></p>'
    out["pages/week1-scenario-lab.html"] = '<p>Lab</p><iframe src="https://x.org/p" data-file="../practice/week1-sort.practice.json"></iframe>'
    out["imsmanifest.xml"] = manifest()
    out["grades_d2l.xml"] = "<grades><items>" + "".join(f'<item id="{i}" resource_code="{c}"><name>{n}</name><type_id>1</type_id><scoring><out_of>{p}</out_of></scoring></item>' for i, (c, n, p) in enumerate(GRADES)) + "</items></grades>"
    folder = '<folder id="{0}" name="{1}" resource_code="{2}" out_of="{3}" grade_item="{4}"{5}>{6}<instructions><text>&lt;p&gt;Do it&lt;/p&gt;</text></instructions></folder>'
    out["dropbox_d2l.xml"] = "<dropbox>" + folder.format(1, "Planning Memo", "CODE-A1", 20, "G1", ' condition_set="COND-1"', "<associations><rubric>RUB-1</rubric></associations>") + folder.format(2, "Data Snapshot Worksheet", "CODE-A2", 10, "G2", "", "") + folder.format(3, "Reflection Journal", "CODE-A3", 8, "G3", "", "") + folder.format(4, "Peer Review", "CODE-A4", 5, "G4", "", "") + "</dropbox>"
    topic = '<topic id="{0}" resource_code="{1}"><content><title>{2}</title><description><text>&lt;p&gt;Talk&lt;/p&gt;</text></description></content><properties><grade_item_id>{3}</grade_item_id><is_hidden>false</is_hidden></properties></topic>'
    out["discussion_d2l_1.xml"] = '<discussion><forum id="F1" resource_code="CODE-F1"><content><title>Forum</title></content><properties><is_hidden>false</is_hidden></properties><topics>' + topic.format("T1", "CODE-D1", "Planning Assumptions Discussion", "G5") + topic.format("T2", "CODE-D2", "Peer Reply Discussion", "G6") + topic.format("T3", "CODE-D3", "Open Questions", "") + "</topics></forum></discussion>"
    out["checklist_d2l.xml"] = '<checklists><checklist id="1" resource_code="CODE-CL1"><name>Week 1 Checklist</name><category sort_order="1"><name>Before</name><item sort_order="2"><name>Second</name></item><item sort_order="1"><name>First</name></item><item><name>Zero</name></item></category></checklist></checklists>'
    out["quiz_d2l_100.xml"] = '<questestinterop><assessment id="100" ident="q" title="Readiness Quiz" d2l:resource_code="CODE-Q1" xmlns:d2l="u"><assess_procextension><grade_item resource_code="G7">G7</grade_item><is_active>yes</is_active><attempts_allowed>2</attempts_allowed><time_limit>0</time_limit></assess_procextension><section title="Part"><item ident="i1"/></section></assessment></questestinterop>'
    out["conditionalrelease_d2l.xml"] = '<release><condition_set resource_code="COND-1" tool="x"><condition condition_type="1" quiz="CODE-Q1"/></condition_set></release>'
    cell = '<cell level_id="L{0}" cell_value="{1}"><description><text>{2}</text></description></cell>'
    criterion = lambda n, o: f'<criterion name="{n}" sort_order="{o}"><cells>{cell.format(1, "10.000000000", "Good")}{cell.format(2, "5.000000000", "Less")}</cells></criterion>'
    out["rubrics_d2l.xml"] = f'<rubrics><rubric id="RUB-1" name="Planning Memo Rubric"><criteria_groups><criteria_group><level_set><levels><level level_id="L1" name="Achieving" sort_order="1"/><level level_id="L2" name="Developing" sort_order="2"/></levels></level_set><criteria>{criterion("Evidence use", 2)}{criterion("Planning clarity", 1)}</criteria></criteria_group></criteria_groups><overall_level_set><overall_levels><overall_level name="Achieving" sort_order="1" range_start_value="90.000"/><overall_level name="Developing" sort_order="2" range_start_value="50"/></overall_levels></overall_level_set></rubric></rubrics>'
    for name in ("questiondb.xml", "links_d2l.xml", "survey_d2l_1.xml"):
        out[name] = "<root/>"
    for name in ("assets/equation-screenshot.png", "assets/planning-cycle.png", "assets/unused-diagram.png", "files/week1-case-packet.pdf", "files/hidden-instructor-notes.docx", "files/unlinked-faculty-deck.pptx"):
        out[name] = f"data of {name}"
    out["practice/week1-sort.practice.json"] = '{"title": "Sort <b>it</b>", "type": 0, "questions": [], "sortableItems": [1, 2], "hasScoring": true, "scorePoints": 5}'
    return out


def write_folder(root: str, export_id: str, prefix: str = "", change: dict[str, str] | None = None) -> None:
    for name, text in {**files(), **(change or {})}.items():
        path = os.path.join(root, export_id, prefix + name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as handle:
            handle.write(text)


def write_zip(root: str, export_id: str, prefix: str = "") -> None:
    os.makedirs(root, exist_ok=True)
    with zipfile.ZipFile(os.path.join(root, f"{export_id}.zip"), "w") as archive:
        for name, text in files().items():
            archive.writestr(prefix + name, text)
