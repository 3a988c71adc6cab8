"""Fixed values that results depend on."""

# One name per character of the 21-letter flag text.
RACE_FLAGS = (
    "is_HisL", "is_Mex", "is_CeAm", "is_SoAm", "is_HisO", "is_AsInd", "is_AsChi", "is_AsJap",
    "is_AsKor", "is_AsLao", "is_AsCam", "is_AsVie", "is_Fil", "is_AsO", "is_AA", "is_AmInd",
    "is_PacIG", "is_PacIH", "is_PacIS", "is_PacIO", "is_Whi",
)

# Personal columns that get a missing flag.
PERSONAL_COLUMNS = (
    "birthdate", "firstname", "middlename", "lastname", "suffix", "mainphone", "mainphone_ext",
    "streetaddress1", "streetaddress2", "preferred_firstname", "preferred_lastname",
    "preferred_middlename", "otherfirstname", "otherlastname", "othermiddlename", "secondphone",
    "secondphone_ext", "ssn",
)

# Columns that get a popularity rank, and the share of values kept.
RANK_COLUMNS = ("email_domain", "short_domain", "area_code", "ip0", "ip1", "ip2", "ip3", "city", "state")
RANK_SHARE = 0.3

# Column trimming. Site-specific account and token columns are passed by the caller.
TRIM_PATTERNS = (
    "^tstmp|_date$",
    "^col.*_name$|^col.*_city$|^col.*_state$|^col.*_country$",
    "^integrity_",
    "^campaign*$",
)
TRIM_NAMES = (
    "confirmation", "hs_name", "hs_city", "hs_state", "hs_country", "district_name",
    "term_description", "major_description", "city", "perm_city", "term_start", "term_end",
    "term_code", "signature", "salt", "last_page", "sup_page_code", "ip_address", "email",
    "email_domain", "email_stripped", "status", *PERSONAL_COLUMNS, "ip0", "ip1", "ip2", "ip3",
)

# Fillers, thresholds and report sizes.
FILL_TEXT, FILL_NUMBER = "missing", -100
RULE_MAX_SECONDS = 90
SCORE_THRESHOLD = 0.3
WEEKLY_REPORT = {"n": 6, "lag": 1}
MONTHLY_REPORT = {"n": 7, "lag": 1, "buffer_days": 5}

# Block lists, one value per line in their source form.
FEATURE_DOMAIN_LIST = ("ru", "de", "cr")
PERIOD_DOMAIN_LIST = ("gmail.com", "googlemail.com")
TOP_DOMAIN_LIST = ("tk", "nf")
ADDRESS_DOMAIN_LIST = tuple("""
tempr.email
golld.us
yopmail.net
yopmail.com
yopmail.fr
cool.fr.nf
jetable.fr.nf
nospam.ze.tc
nomail.xl.cx
mega.zik.dj
speed.1s.fr
courriel.fr.nf
moncourrier.fr.nf
monemail.fr.nf
monmail.fr.nf
dayrep.com
0box.eu
armyspy.com
jourrapide.com
teleworm.us
rhyta.com
ymail.com
ciantel.com
temp-mail.org
ciantel.com
upcmaill.com
searchfast.co
denomla.com
usa.com
hatuli.com
moviepo.us
yandex.com
foc.cu.edu.eg
trash-mail.com
re-gister.com
trash-me.com
you-spam.com
fake-box.com
opentrash.com
bossemail.info
altmails.com
sika3.com
tapi.re
kpay.be
heisei.be
honeys.be
mbox.re
kmail.li
prin.be
rapt.be
kksm.be
usako.net
eay.jp
via.tokyo.jp
ichigo.me
choco.la
cream.pink
merry.pink
neko2.net
fuwamofu.com
ruru.be
macr2.com
f5.si
outlook.sa
luottin.com
mailboxt.net
etemp.it
upcmaill.com
wilkinson.biz
sweatmail.com
denomla.com
denomla.net
denomla.org
emailnube.com
yuoia.com
ahk.jp
svk.jp
student.sbccd.edu
umailz.com
umailz.org
umailz.net
denomla.com
pecinan.com
pecinan.org
pecinan.net
panchoalts.org
panchoalts.net
panchoalts.com
now.mefound.com
btcmail.pw
trafficbot.life
bottraffic.live
bot-traffic.xyz
shelove.me
yopmail.com
temporary-mail.net
bestlistbase.com
besttempmail.com
chasefreedomactivate.com
deverob.com
dmcd.ctu.edu.gr
gulfmedic.org
meantinc.com
pnizgotten.com
powerencry.com
rvemold.com
truthfinderlogin.com
unwiki.org
wellsfargocomcardholders.com
unwiki.org
""".split())

# Cells of a CSV file that mean "missing".
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
