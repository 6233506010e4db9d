"""Fixed values for names typed by people: nicknames, titles, words of organisations, devices and roles."""

from __future__ import annotations

#: Given name -> short and pet forms in common use, one line per given name.
NICKNAMES = """
abigail abby gail; aleksandra alexandra ola ala sasha alex sandra lexi; alexander alex alec sandy xander sasha; amanda mandy
andreas andi andy andre; andrew andy drew; angela angie; anna annie anya; anthony tony ant; barbara barb babs
benjamin ben benny benji; bjorn; charles charlie chuck; chloe clo; christina chris tina chrissy
christopher chris kit topher; cynthia cindy; daniel dan danny; david dave davey; deborah deb debbie debby; dorothy dot dottie
edward ed eddie ted teddy ned; eleanor ellie nell nora; elizabeth liz lizzie beth betty betsy eliza libby bess; emily em emmy
eugene gene; frances fran; francisco paco pancho fran curro kiko; frederick fred freddie freddy; gabriel gabe; gabriela gabi gaby
gerald gerry jerry; giovanni gianni nino; giuseppe beppe pino peppe; gregory greg; guillermo memo willy; hannah hanna; harold harry hal
helen nell nellie; henry harry hank; ignacio nacho inaki; ines; isabella bella izzy; jacqueline jackie jacqui; james jim jimmy jamie
jan; jeffrey jeff; jennifer jen jenny jenn; jessica jess jessie; johannes hans jo; john jack johnny; jonathan jon jonny nathan
jose pepe pepito chepe; joseph joe joey; joshua josh; judith judy; juliana jules; katarzyna kasia; katherine catherine kathryn cathy kate cat kathy katie kat kitty kathie
kenneth ken kenny; konrad konni conny kurt; laura lori; lawrence larry lars laurie; leonard len lenny leo; luigi gigi; manuel manolo manu
margaret maggie peggy meg madge marge greta; maria mia; martha marty; mary molly polly; matthew matt matty; michael mike mick micky mikey
nancy nan; natalia natasha; nathaniel nate nat; nicholas nick nicky nico claus; oksana ksenia oksanka xenia; pamela pam; patricia pat patty trish tricia
patrick pat paddy; peter pete; philip phil; priya pri; raul rulo; raymond ray; rebecca becca becky bex; rene; richard rick dick rich ricky richie
robert bob rob bobby robbie bert; roland rolly; ronald ron ronnie; samantha sam; samuel sam sammy; sophia sophie; stanislaw stas; stephen steve stevie
susan sue susie suzy; theodore ted teddy theo; thomas tom tommy; timothy tim timmy; valentina vale; victor vic; victoria vicky tori vic vicki
vincent vince vinny; vladimir vova; walter walt wally; william will bill billy willy liam; wilhelm willi; yusuf yusef joey; zachary zach; zoe
"""

#: Words before a name that are no part of it.
TITLES = set("cr cllr councillor mr mrs ms mx miss dr prof professor sir dame rev herr frau mme mlle sr sra don dona ing".split())

#: Legal forms and articles of organisations.
LEGAL_FORMS = set("ltd limited inc incorporated llc plc gmbh corp corporation co company ag sa the".split())

#: Words that kinds of organisations are named by, with usual abbreviations.
ORGANISATION_WORDS = {
    "agency": "", "association": "assoc assn ass", "authority": "auth", "board": "bd brd", "bureau": "", "centre": "center ctr", "club": "", "college": "coll",
    "commission": "comm cmn", "committee": "cttee cmte", "cooperative": "coop co-op", "council": "cncl", "department": "dept", "district": "", "energy": "en", "federation": "fed",
    "forum": "", "foundation": "fdn", "group": "grp", "harbour": "harbor hbr", "health": "", "heritage": "her", "hospital": "hosp", "housing": "hsg", "institute": "inst",
    "library": "lib", "museum": "", "network": "", "office": "off", "partnership": "", "planning": "plan plg", "police": "", "school": "sch", "service": "svc", "services": "svcs",
    "society": "soc", "sports": "", "team": "", "theatre": "theater", "transit": "trans", "transport": "", "trust": "tr", "union": "", "university": "univ", "water": "wtr", "youth": "yth",
}

#: Words that name a device; an owner may stand before one.
DEVICES = set("iphone ipad ipod laptop phone macbook tablet pc computer desktop mac galaxy tab pixel android surface chromebook handy mobile".split())

#: Words that name a role, a room or nobody in particular.
NOBODY = set("host cohost guest user participant zoom teams meeting room conference reception admin moderator presenter speaker unknown anonymous attendee caller dial in recording lobby front desk hall boardroom".split())

#: What clients and people put behind a name: pronouns, states, roles and departments, after a bar or dash or in brackets.
REMARKS = set("host cohost co-host guest muted presenter organizer organiser moderator admin she her he him they them hers his theirs me you away external panelist".split())

#: Rows of letters on a keyboard, and letters that look alike on a screen.
KEY_ROWS = "qwertyuiop asdfghjkl zxcvbnm"
LOOKALIKES = "ce il uv gq bh"
