"""Names, lists, edges, weights and patterns that results depend on.

Everything here is data. Code elsewhere reads it and holds no copies.
"""

# --- source projections: column in the source table -> column in the extract

ACCOUNT_COLUMNS = {
    "code": "AccountId",
    "Account_Name": "AccountName",
    "Outreach_Account_Natural_Name": "CleanName",
    "Type": "AccountType",
    "Website": "Website",
    "Annual_Revenue": "AnnualRevenue",
    "NumberofEmployees": "NumberofEmployees",
    "SIC_Code": "SIC",
    "IndustryProfileFinal": "IndustryProtfolio",
    "IndustrySubPortfolio_GTMPlanningFinal": "IndustrySubPortfolio",
    "Primary_Industry_c": "PrimaryIndustry",
    "Sub_Industry": "SubIndustry",
    "Billing_City": "BillingCity",
    "BillingState": "BillingState",
    "BillingPostalCode": "BillingPostalCode",
    "BillingCountry": "BillingCountry",
    "Final_pod": "POD",
    "Final_Geo": "Geo",
    "DNBDUNSNumber": "DUNSNumber",
    "DnBCompanyRecord": "DnBCompanyRecord",
}

OPPORTUNITY_COLUMNS = {
    "AccountId": "AccountId",
    "OpportunityId": "OpportunityId",
    "Display_Name": "OpportunityName",
    "New_Or_Expand": "New_Or_Expand",
    "SF_ACV_New_Expand_Converted": "ACVNewExpandConverted",
    "StageName": "StageName",
    "True_Stage": "True_Stage",
    "CreatedDate": "CreatedDate",
    "First_Opp_Created_Date_c": "FirstOppCreatedDate",
    "Stage1_Date": "Stage1Date",
    "Stage2_Date": "Stage2Date",
    "Stage3_Date": "Stage3Date",
    "Stage4_Date": "Stage4Date",
    "Final_CloseDate": "CloseDate",
    "SQL_Source_Type_c": "SQLSourceType",
    "SQL_SourcefromSalesFcst": "SQLSourcefromSalesFcst",
    "SQL_Created_Date_c": "SQLCreatedDate",
    "First_MQL_Created_Date_c": "FirstMQLCreatedDate",
    "First_Approved_SDR_Meeting_Date__c": "FirstApprovedSDRMeetingDate",
    "Record_Type_text_c": "RecordType",
    "Reason__c": "Reason",
    "Reason_Details__c": "ReasonDetails",
    "Duplicate_Opportunity_Link__c": "DuplicateOpportunityLink",
}
OPPORTUNITY_DATES = [
    "CreatedDate", "FirstOppCreatedDate", "Stage1Date", "Stage2Date", "Stage3Date", "Stage4Date",
    "CloseDate", "SQLCreatedDate", "FirstMQLCreatedDate", "FirstApprovedSDRMeetingDate",
]
OPPORTUNITY_CATEGORIES = [
    "New_Or_Expand", "StageName", "True_Stage", "SQLSourceType", "SQLSourcefromSalesFcst",
    "RecordType", "Reason",
]
ADJUSTED_CREATED_COLUMN = "AdustedCreatedDate"
ADJUSTED_CREATED_MONTHS = 13

CAMPAIGN_COLUMNS = {
    "Code": "CampaignId",
    "Name": "CampaignName",
    "Campaign_ParentID": "CampaignParentId",
    "Campaign_ParentName": "CampaignParentName",
    "Final_Channel": "CampaignChannel",
    "LOB": "CampaignLOB",
    "Industry": "CampaignIndustry",
    "IsActive": "CampaignStatus",
}
CAMPAIGN_CATEGORIES = [
    "CampaignChannel", "CampaignChannels", "CampaignLOB", "CampaignIndustry", "CampaignStatus",
]

MEMBER_COLUMNS = {
    "Code": "MemberId",
    "ContactLeadID": "ContactId",
    "Type": "ContactType",
    "LOB": "LOB",
    "Final_AccountID": "AccountId",
    "Account_Name": "AccountName",
    "CampaignId": "CampaignId",
    "Campaign": "Campaign",
    "CampaignMember_Status": "CampaignMemberStatus",
    "HasResponded": "HasResponded",
    "CreatedDate": "CreatedDate",
    "FirstRespondedDate": "FirstRespondedDate",
    "Channel_Campaign": "ChannelCampaign",
    "Channel_Medium": "ChannelMedium",
    "Channel_Source": "ChannelSource",
    "Channel_Campaign_Final": "ChannelCampaignFinal",
    "Final_Campaign_Channel": "FinalCampaignChannel",
    "edw_lead_channel": "EDWChannel",
    "Campaign_Channels": "CampaignChannels",
}
CONTACT_COLUMNS = {
    "Name": "ContactName",
    "Email": "Email",
    "Job_Level": "JobLevel",
    "Job_Function": "JobFunction",
}
CONTACT_KEY = "Code"
MEMBER_CONTACT_KEY = "ContactLeadID"
MEMBER_DATES = ["CreatedDate", "FirstRespondedDate"]
MEMBER_INTEGERS = ["CampaignMemberStatus", "HasResponded"]
MEMBER_CATEGORIES = [
    "ContactType", "LOB", "ChannelCampaign", "ChannelMedium", "ChannelSource",
    "ChannelCampaignFinal", "FinalCampaignChannel", "EDWChannel", "CampaignChannels", "JobLevel",
    "JobFunction",
]

COUNTRY_COLUMNS = {
    "id": "Id",
    "name": "Name",
    "iso3": "ISO3",
    "iso2": "ISO2",
    "capital": "Capital",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "tld": "TLD",
    "native": "Native",
    "nationality": "Nationality",
}
STATE_COLUMNS = {
    "id": "Id",
    "name": "Name",
    "country_id": "CountryId",
    "country_code": "CountryISO2",
    "country_name": "CountryName",
    "state_code": "Code",
    "type": "Type",
    "latitude": "Latitude",
    "longitude": "Longitude",
}
WORD_LIST_COLUMN = "string_field_0"

# --- country and state names

COUNTRY_NAMES = {
    "The Bahamas": "Bahamas",
    "Virgin Islands (British)": "British Virgin Islands",
    "Cape Verde": "Cabo Verde",
    "Democratic Republic of the Congo": "Congo, Democratic Republic of the",
    "Czech Republic": "Czechia",
    "Fiji Islands": "Fiji",
    "Aland Islands": "Åland Islands",
    "Gambia The": "Gambia",
    "Palestinian Territory Occupied": "Palestine",
    "Vatican City State (Holy See)": "Holy See (Vatican City State)",
    "Hong Kong S.A.R.": "Hong Kong",
    "Cote D'Ivoire (Ivory Coast)": "Côte d'Ivoire",
    "North Korea": "Korea, Democratic People's Republic of",
    "South Korea": "Korea, Republic of",
    "Macau S.A.R.": "Macao",
    "Curaçao": "Curaçao",
    "Sint Maarten (Dutch part)": "Sint Maarten",
    "Bonaire, Sint Eustatius and Saba": "Bonaire, Sint Eustatius, and Saba",
    "Micronesia": "Micronesia, Federated States of",
    "Pitcairn Island": "Pitcairn Islands",
    "East Timor": "Timor-Leste",
    "Russia": "Russian Federation",
    "Saint-Barthelemy": "Saint Barthelemy",
    "Saint Helena": "Saint Helena, Ascension and Tristan da Cunha",
    "Saint-Martin (French part)": "Saint Martin",
    "Svalbard And Jan Mayen Islands": "Svalbard and Jan Mayen",
    "Swaziland": "Eswatini",
    "Guernsey and Alderney": "Guernsey",
    "Man (Isle of)": "Isle of Man",
    "United States": "United States of America",
    "Virgin Islands (US)": "U. S. Virgin Islands",
    "Wallis And Futuna Islands": "Wallis and Futuna",
}
STATE_NAMES = {
    "Central Singapore": "Singapore",
    "Metro Manila": "Manila",
    "Auckland Region": "Auckland",
    "North Rhine-Westphalia": "Nordrhein-Westfalen",
    "Hong Kong SAR": "Hong Kong",
    "Lower Saxony": "Niedersachsen",
    "Ile de France": "Ile-de-France",
    "North Holland": "Noord-Holland",
    "South Holland": "Zuid-Holland",
    "Hesse": "Hessen",
    "Bavaria": "Bayern",
}
STATE_WORDS = [
    "District", "Municipality", "Province", "Region", "County", "Prefecture", "Department",
    "Oblast", "Atoll", "City of", "London Borough of ",
]
# lookup columns in rising priority
COUNTRY_LOOKUP = ["CountryName", "Name", "Name_Eng", "ISO3", "ISO2"]
STATE_LOOKUP = ["StateName", "Name_Eng", "Name", "Code"]
OLD_COUNTRY_LOOKUP = ["CountryName", "Country_Name", "Country_ISO3", "Country_ISO2"]
OLD_STATE_LOOKUP = ["State_Name", "State_Code"]
OLD_CITY_LOOKUP = ["City_Name"]

# --- jobs

OTHERS = "Others"
JOB_LEVELS = ["C-Level", "Director", "Manager", "SVP", "VP"]
JOB_LEVEL_NAMES = {"C Level": "C-Level", "C-Suite": "C-Level", "VP Level": "VP", "": "Others"}
JOB_FUNCTIONS = [
    "Finance", "Marketing", "Sales", "Supply Chain", "Information Technology", "Human Resources",
    "G&A",
]
JOB_FUNCTION_WORDS = {
    "Finance": ["finance", "financial", "accounting", "treasury", "tax"],
    "Marketing": [
        "marketing", "Demand Generation", "Brand Management", "Corporate Strategy",
        "Strategic Communications", "Business Development", "Lead Generation", "Customer",
        "Advertising",
    ],
    "Sales": ["sales", "executive", "account"],
    "Supply Chain": ["logistics", "operations", "procurement"],
    "Information Technology": [
        "IT", "devops", "software", "ui", "ux", "Information Technology", "data", "service",
        "support", "engineer", "tech", "product", "project", "machine", "artificial",
        "intelligence", "engine", "application", "ecommerce", "research", "Networking",
    ],
    "Human Resources": ["workforce", "talent", "human", "resource", "employee", "pr"],
    "G&A": [
        "legal", "risk", "Governmental Affairs & Regulatory Law", "Leasing",
        "Organizational Development",
    ],
}

# --- text patterns

URL_NOISE = r"^((?:https?://)?(?:www\.)?)|(?:\:\d{2,5})"
BRACKETED = r"(?md)\([^()]*\)|\[[^\[\]]*\]|\([^()]*$|\[[^\[\]]*$"
SEPARATORS = r"[,-]"
COLUMN_NAME_NOISE = r"[^A-Za-z0-9]+"
# common legal forms of companies, from public registers
LEGAL_FORMS = [
    "ab", "ag", "a/s", "as", "bhd", "bv", "b.v.", "co", "company", "corp", "corporation", "gmbh",
    "inc", "incorporated", "kg", "kk", "k.k.", "limited", "llc", "l.l.c.", "llp", "l.l.p.", "lp",
    "l.p.", "ltd", "ltda", "nv", "n.v.", "oy", "oyj", "plc", "pty", "pte", "pvt", "s.a.", "sa",
    "s.a.s.", "sas", "s.p.a.", "spa", "s.r.l.", "srl", "sarl", "sdn", "se",
]

# --- bins

DEFAULT_BIN_EDGES = [-1, 0, 3, 10, 25, 50, 75, 100]
REVENUE_BIN_EDGES = [
    -1, 0, 1_000_000, 10_000_000, 100_000_000, 300_000_000, 500_000_000, 1_000_000_000,
]
CONFIDENCE_BIN_EDGES = [-1, 0, 50, 60, 70, 80]

# --- aggregation names

AGGREGATE_NAMES = {"mean": "Avg", "sum": "Sum", "count": "#"}
ROW_TOTAL = "RowTotal"
TOTAL = "Total"
GRAND_TOTAL = "Grand Total"
TOTAL_AVERAGE = "Total Average"

# --- campaign touches: flag -> (opens after, closes at)

RESPONDED = "CM_FirstRespondedDate"
OPENED = "OPP_AdustedCreatedDate"
CLOSED = "OPP_CloseDate"
TOUCH_STAGES = {
    "Stage1Touch": ("OPP_AdustedCreatedDate", "OPP_Stage1Date"),
    "Stage2Touch": ("OPP_Stage1Date", "OPP_Stage2Date"),
    "Stage3Touch": ("OPP_Stage2Date", "OPP_Stage3Date"),
    "Stage4Touch": ("OPP_Stage3Date", "OPP_Stage4Date"),
    "Stage5Touch": ("OPP_Stage4Date", "OPP_CloseDate"),
}
TOUCH_COUNT = "StageTouch"
MEMBER_ID = "CM_MemberId"
CHANNEL = "CM_CampaignChannels"

# --- revenue source

REVENUE_CUTOFF = 10

# --- linkage

MATCH_THRESHOLD = 0.85
CONFIDENCE_WEIGHTS = {
    "Match_AccountName|Match_WebsiteClean|Match_Domain": 40,
    "Match_BillingCity": 20,
    "Match_BillingStateClean": 10,
    "Match_BillingPostalCode": 20,
    "Match_BillingCountryClean": 10,
}
ACCOUNT_FEATURES = "Match_AccountName|Match_WebsiteClean|Match_Domain"

LINK_RULES = {
    "ZoomInfo": {
        "index": {"block": {"SF_AccountId": ["ZI_AccountId"]}, "sortedneighbour": {}},
        "compare": {
            "SF_AccountName": ["ZI_AccountName"],
            "SF_AccountNameClean": ["ZI_AccountNameClean"],
            "SF_WebsiteClean": ["ZI_WebsiteClean"],
            "SF_DomainClean": ["ZI_DomainClean"],
            "SF_BillingCity": ["ZI_City"],
            "SF_BillingStateClean": ["ZI_StateClean"],
            "SF_BillingPostalCode": ["ZI_PostalCode"],
            "SF_BillingCountryClean": ["ZI_CountryClean"],
            "SF_AnnualRevenue": ["ZI_AnnualRevenue"],
            "SF_NumberofEmployees": ["ZI_NumberofEmployees"],
            "SF_SIC": ["ZI_SICCode"],
        },
    },
    "DNB": {
        "index": {"block": {"SF_DNBCompanyProfile": ["DNB_Id"]}, "sortedneighbour": {}},
        "compare": {
            "SF_AccountName": ["DNB_BusinessName"],
            "SF_AccountNameClean": ["DNB_BusinessNameClean"],
            "SF_WebsiteClean": ["DNB_WebsiteClean"],
            "SF_DomainClean": ["DNB_DomainClean"],
            "SF_BillingCity": ["DNB_City"],
            "SF_BillingStateClean": ["DNB_StateClean"],
            "SF_BillingPostalCode": ["DNB_PostalCode"],
            "SF_BillingCountryClean": ["DNB_CountryClean"],
            "SF_DUNSNumber": ["DNB_DUNSNumber"],
            "SF_AnnualRevenue": ["DNB_AnnualRevenue"],
            "SF_NumberofEmployees": ["DNB_NumberofEmployees"],
            "SF_SIC": ["DNB_SICCode"],
        },
    },
    "name": {
        "index": {
            "block": {},
            "sortedneighbour": {
                "SF_AccountName": ["INP_Company", "INP_Outreach_Account_Natural_Name"],
                "SF_CleanName": ["INP_Outreach_Account_Natural_Name"],
            },
        },
        "compare": {
            "SF_AccountName": ["INP_Company", "INP_Outreach_Account_Natural_Name"],
            "SF_CleanName": ["INP_Outreach_Account_Natural_Name"],
        },
    },
}
OLD_LINK_RULES = {
    "ZoomInfo": {
        "index": {"block": {"SF_AccountId": ["ZI_AccountId"]}, "sortedneighbour": {}},
        "compare": {
            "SF_AccountName": ["ZI_AccountName"],
            "SF_WebsiteClean": ["ZI_WebsiteClean"],
            "SF_DomainClean": ["ZI_DomainClean"],
            "SF_BillingCity": ["ZI_City"],
            "SF_BillingState": ["ZI_State"],
            "SF_BillingPostalCode": ["ZI_PostalCode"],
            "SF_StandardizedCountry": ["ZI_StandardizedCountry"],
        },
    },
    "name": LINK_RULES["name"],
}
FIELD_MAPPINGS = {
    "ZoomInfo": {
        "SF_AccountName": {"on": "ZI_AccountName", "index": "sortedneighbourhood"},
        "SF_WebsiteClean": {"on": "ZI_WebsiteClean"},
        "SF_DomainClean": {"on": "ZI_DomainClean"},
        "SF_BillingCity": {"on": "ZI_City"},
        "SF_BillingState": {"on": "ZI_State"},
        "SF_BillingPostalCode": {"on": "ZI_PostalCode"},
        "SF_BillingCountry": {"on": "ZI_Country", "index": "block"},
    },
    "adhoc": {
        "SF_AccountName": "INP_COMPANY",
        "SF_CleanName": "INP_Outreach_Account_Natural_Name",
        "SF_BillingState": "INP_STATE",
        "SF_BillingCountry": "INP_COUNTRY",
    },
    "name": {
        "SF_AccountName": {"on": "INP_Company", "index": "sortedneighbourhood"},
        "SF_CleanName": {"on": "INP_Outreach_Account_Natural_Name"},
    },
}
