"""Positional layouts of the report records.

Fixed values: the record codes, field names, order and types are given by the
file format.
"""

from __future__ import annotations

from dataclasses import dataclass

LAYOUT_FIELDS = {
    "HEAD": """
        MessageVersion string, Profile string, ProfileVersion string, MessageId string,
        MessageCreatedDateTime string, FileNumber long, NumberOfFiles long, UsageStartDate date,
        UsageEndDate date, SenderPartyId string, SenderName string, ServiceDescription string,
        RecipientPartyId string, RecipientName string, RepresentedRepertoire string
    """,
    "SY05.03": """
        SummaryRecordId string, DistributionChannel string, DistributionChannelDPID string,
        CommercialModel string, UseType string, Territory string, ServiceDescription string,
        RightsController string, RightsControllerPartyId string, RightsType string,
        TotalUsages long, AllocatedUsages double, MusicUsagePercentage double,
        AllocatedNetRevenue double, AllocatedRevenue double, RightsControllerMarketShare double,
        CurrencyOfReporting string, CurrencyOfTransaction string, ExchangeRate double,
        SubscriberType string, SubPeriodStartDate string, SubPeriodEndDate string,
        ContentCategory string, RightsTypePercentage double, ParentSummaryRecordId string
    """,
    "SY02.03": """
        SummaryRecordId string, DistributionChannel string, DistributionChannelDPID string,
        CommercialModel string, UseType string, Territory string, ServiceDescription string,
        TotalUsages long, Users long, CurrencyOfReporting string, NetRevenue double,
        RightsController string, RightsControllerPartyId string, AllocatedUsages double,
        AllocatedRevenue double, AllocatedNetRevenue double, RightsType string,
        ContentCategory string, CurrencyOfTransaction string, ExchangeRate double,
        RightsTypePercentage double
    """,
    "AS01.02": """
        BlockId string, ResourceReference string, DspResourceId string, ResourceISRC string,
        ResourceTitle string, ResourceSubTitle string, ResourceDisplayArtistName string,
        ResourceDisplayArtistPartyId string, ResourceDuration string, ResourceType string,
        IsMasterRecording string, IsSubjectToOwnershipConflict string, LastConflictCheck string
    """,
    "RU01.02": """
        BlockId string, SummaryRecordId string, DspReleaseId string, Usages string,
        ContentCategory string, ParentResourceReference string
    """,
    "SU03.02": """
        BlockId string, SalesTransactionId string, SummaryRecordId string, DspResourceId string,
        Usages double, NetRevenue double, ValidityPeriodStart string, DATE_SALE string,
        ContentCategory string, IsRoyaltyBearing string
    """,
    "LI01.03": """
        BlockId string, SummaryRecordId string, RightsController string,
        RightsControllerPartyId string, PUBLISHERS_SONGCODE string, RightSharePercent double,
        RightsType string, AllocatedNetRevenue double, AllocatedAmount double,
        AllocatedUsages double, ParentSalesTransactionId string, LicensorDataRecordId string
    """,
    "MW01.02": """
        BlockId string, DspMusicalWorkId string, MusicalWorkISWC string, MusicalWorkTitle string,
        MusicalWorkSubTitle string, MusicalWorkComposerAuthorName string,
        MusicalWorkComposerAuthorPartyId string, MusicalWorkArrangerName string,
        MusicalWorkArrangerPartyId string, MusicPublisherName string,
        MusicPublisherPartyId string, MusicalWorkContributorName string,
        MusicalWorkContributorPartyId string, DataProviderName string,
        ProprietaryMusicalWorkId string, ResourceReference string,
        ParentLicensorDataRecordId string, ParentMasterlistId string
    """,
    "LC01": """
        BlockId string, ResourceReference string, DspResourceId string, ISRC string,
        ResourceTitle string, ResourceSubTitle string, ResourceDisplayArtistName string,
        ResourceDisplayArtistPartyId string, ResourceDuration string, ResourceType string,
        MusicalWorkISWC string, MusicalWorkComposerAuthorName string,
        MusicalWorkComposerAuthorPartyId string, MusicalWorkArrangerName string,
        MusicalWorkArrangerPartyId string, MusicPublisherName string,
        MusicPublisherPartyId string, MusicalWorkContributorName string,
        MusicalWorkContributorPartyId string, ProprietaryMusicalWorkId string,
        DataProviderName string, IsSubjectToOwnershipConflict string
    """,
    "SY04.02": """
        SummaryRecordId string, DistributionChannel string, DistributionChannelDPID string,
        CommercialModel string, UseType string, Territory string, ServiceDescription string,
        SubscriberType string, Subscribers long, SubPeriodStartDate string,
        SubPeriodEndDate string, TotalUsagesInSubPeriod long, TotalUsagesInReportingPeriod long,
        CurrencyOfReporting string, CurrencyOfTransaction string, ExchangeRate double,
        ConsumerPaidUnitPrice double, NetRevenue double, MusicUsagePercentage double
    """,
    "SY09.01": """
        SummaryRecordId string, CommercialModel string, UseType string, Territory string,
        ServiceDescription string, SubscriberType string, RightsController string,
        RightsControllerPartyId string, RightsType string, TotalUsages double,
        AllocatedUsages double, NetRevenue double, IndirectValue double,
        RightsControllerMarketShare string, CurrencyOfReporting string,
        CurrencyOfTransaction string, ExchangeRate string, RightsTypePercentage string,
        SubPeriodStartDate string, SubPeriodEndDate string, ParentSummaryRecordId string
    """,
    "ST01": """
        BlockId string, ParentSalesTransactionId string, SummaryRecordId string, Usages long
    """,
}

# The table a record code is stored in. Both summary variants
# share one table.
TABLE_OF_CODE = {
    "HEAD": "HEAD",
    "SY05.03": "SY03",
    "SY02.03": "SY03",
    "AS01.02": "AS0102",
    "RU01.02": "RU0102",
    "SU03.02": "SU0302",
    "LI01.03": "LI0103",
    "MW01.02": "MW0102",
    "LC01": "LC01",
    "SY04.02": "SY0402",
    "SY09.01": "SY0901",
    "ST01": "ST01",
}

SUMMARY_WIDE = "SY05.03"
SUMMARY_NARROW = "SY02.03"


@dataclass(frozen=True)
class Field:
    name: str
    type: str


LAYOUTS: dict[str, tuple[Field, ...]] = {
    code: tuple(Field(*field.split()) for field in fields.split(","))
    for code, fields in LAYOUT_FIELDS.items()
}
