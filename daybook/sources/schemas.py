"""Declared schemas of the three raw tables, and fitting a DataFrame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Column names and types of the declared tables, in order. A name that is declared
# twice is kept once.
_MEMBER = """
id INT NOT NULL, oldloyaltyid STRING, enrollmentdate TIMESTAMP_NTZ, enrollmentchannelcode STRING,
enrollmentstorecode STRING, card_no STRING, title STRING, firstname STRING, lastname STRING,
gender STRING, dob DATE, agegroup STRING, maritalstatus STRING, spousename STRING, spousedob DATE,
anniversary DATE, mobilenumber STRING, mobilenumber2 STRING, landlineno STRING, email STRING,
address STRING, city STRING, state STRING, pincode STRING, interestedinprogramcommunication STRING,
purchasedfor STRING, wearspectacles STRING, buyjewellery STRING, buywatch STRING,
mothertongue STRING, nri STRING, profession STRING, workingwith STRING, designation STRING,
festivalscelebrateother STRING, festivalsicelebrate STRING, buyingoccasionforjewellary STRING,
children1 STRING, children1name STRING, children1dob DATE, children2 STRING, children2name STRING,
children2dob DATE, children3 STRING, children3name STRING, children3dob DATE,
wearspectaclesinfamily STRING, wearlensinfamily STRING, reasonforpurchasespectacle STRING,
buyspectacles STRING, author STRING, actor STRING, singer STRING, sportsperson STRING,
hobbies STRING, tiername STRING, pointbalance DECIMAL(15,2), hotlistedcard BOOLEAN,
dndregisteredsms BOOLEAN, dndregisteredcall BOOLEAN, validemailid BOOLEAN, validaddress BOOLEAN,
interestedinspecialoffers BOOLEAN, enrollmentsource STRING, shoppingexperience STRING,
staffservice STRING, visitagain STRING, recommendfriend STRING, receiveaccountrelatedcomm BOOLEAN,
receiveproductrelatedcomm BOOLEAN, receivesurveysfeedbackscomm BOOLEAN, frequencyofcomm STRING,
receivesuggestionfeedbacksurveycomm STRING, musician STRING, artists STRING, food STRING,
dancers STRING, memberstatus STRING, createdbygroupname STRING, updatedbygroupname STRING,
firstprofileupdatedby STRING, firstprofileupdateddate DATE, lastprofileupdatedby STRING,
lastprofileupdateddate DATE, datacapturedthrough STRING, whowearspectacles BOOLEAN, self BOOLEAN,
spouse BOOLEAN, parents BOOLEAN, children BOOLEAN, sparespectacle BOOLEAN, adventure BOOLEAN,
cricket BOOLEAN, carmotors BOOLEAN, football BOOLEAN, swimming BOOLEAN, tennis BOOLEAN,
water BOOLEAN, golf BOOLEAN, sportsothers BOOLEAN, art BOOLEAN, cinema BOOLEAN, music BOOLEAN,
culinary BOOLEAN, reading BOOLEAN, photography BOOLEAN, socialnetworking BOOLEAN, theatre BOOLEAN,
yoga BOOLEAN, healthwellness BOOLEAN, hobbiesothers STRING, termsandconditions BOOLEAN,
publicprivatesector STRING, {fb}, {tw}, {li}, emailstatus STRING, mobilestatus STRING,
alternateemail STRING, country STRING, ltv_shoppingamount DECIMAL(15,2),
ltv_eligibleamount DECIMAL(15,2), campaigncode STRING, enrolledcampaigncode STRING,
smsstatus STRING, callstatus STRING, whatsappstatus STRING, accountsignupstatus STRING,
marketingcommunicationsstatus STRING, {program}rewardsstatus STRING, feedbacksurveysstatus STRING,
shoppingexperiencestatus STRING, customeranalyticsinsightsstatus STRING,
birthdayanniversarygreeting STRING
"""
_SOCIAL_PROFILE = """
{net}socialmediaid STRING, {net}firstname STRING, {net}lastname STRING, {net}gender STRING,
{net}locale STRING, {net}fullname STRING, {net}profilelink STRING, {net}status STRING,
{net}dateofbirth DATE, {net}associatedemailid STRING, {net}education STRING, {net}religion STRING,
{net}languages STRING, {net}relationshipstatus STRING, {net}timezone STRING, {net}work STRING,
{net}bio STRING, {net}industry STRING
"""
CAMPAIGN_DDL = """
id INT NOT NULL, Unnamed_0 STRING, Sl_No DOUBLE, Region STRING, Campaign_Name STRING, Brand STRING,
Channel STRING, Customer_cut STRING, Other_Details STRING, Deployment_date STRING, Month STRING,
Status STRING, Overall STRING, Target_Count STRING, Buyers STRING, Sale_Value STRING, ATS STRING,
Conversion STRING, Unnamed_17 STRING, Control_Count STRING, Buyers1 STRING, Sale_Value1 STRING,
ATS1 STRING, Conversion1 STRING, lift_ STRING, Incremental_rev STRING, Conversion_to_AED STRING,
Conversion_to_USD STRING, Unnamed_27 DOUBLE, Unnamed_28 DOUBLE, Unnamed_29 DOUBLE,
Unnamed_30 DOUBLE, Unnamed_31 DOUBLE, Unnamed_32 DOUBLE, Unnamed_33 DOUBLE, Unnamed_34 STRING,
Unnamed_35 DOUBLE, Unnamed_36 DOUBLE, Unnamed_37 DOUBLE, Unnamed_38 DOUBLE, Unnamed_39 DOUBLE,
Unnamed_40 DOUBLE, Unnamed_41 DOUBLE, Unnamed_42 DOUBLE
"""
TRANSACTION_DDL = """
id INT NOT NULL, transactionid STRING, oldloyaltyid STRING, cardno STRING, tiername STRING,
rewardpostingdate DATE, invoice_no STRING, invoice_date DATE, channel STRING, category STRING,
brand STRING, qty BIGINT, storecode STRING, campaignname STRING, currencysymbol STRING,
shopping_amount DECIMAL(15,3), eligible_amount DECIMAL(15,4), earn DECIMAL(15,4),
spent DECIMAL(15,4), remarkstype STRING, remarks STRING, discountheader DECIMAL(15,5),
earned_invoicedate DATE, earned_invoicenumber STRING, earned_channel STRING, earned_outlet STRING,
earned_lineitemnumber DECIMAL(15,5)
"""


def member_schema(program: str) -> T.StructType:
    """``program`` is the loyalty programme's name, which one column carries as its prefix."""
    return T.StructType.fromDDL(member_ddl(program))


def member_ddl(program: str) -> str:
    profiles = {net: _SOCIAL_PROFILE.format(net=net).strip() for net in ("fb", "tw", "li")}
    return _MEMBER.format(program=program, **profiles)


def transaction_schema() -> T.StructType:
    return T.StructType.fromDDL(TRANSACTION_DDL)


def campaign_schema() -> T.StructType:
    return T.StructType.fromDDL(CAMPAIGN_DDL)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types. Unreadable values and missing columns are null,
    columns the schema does not know are dropped; names match without regard to case."""
    present = {name.lower(): name for name in df.columns}

    def fitted(field: T.StructField):
        name = present.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if name is None else F.col(f"`{name}`").try_cast(field.dataType)
        return value.alias(field.name)

    return df.select([fitted(field) for field in schema])
