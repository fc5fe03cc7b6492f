"""The four record layouts.

Fixed values: positions, names, pads, defaults and constant bytes are given by
the record format.  Everything not listed is blank.
"""

from __future__ import annotations

from slotline.layouts.model import Layout, Slot

FILE_HEADER = Layout(
    record_type="FILE_HEADER",
    width=41,
    slots=(
        Slot(5, 6, "Phase", "R ", "@phase", None),
        Slot(7, 11, "Workload ID", "L0", "@mac_id", None),
        Slot(12, 16, "MAC ID", "L0", "@mac_id", None),
        Slot(17, 24, "Extract Cycle Date", "R ", "@cycle_date", None),
    ),
    constants=((1, "MAP"), (4, "H"), (25, "D"), (34, "20250106")),
)

FILE_TRAILER = Layout(
    record_type="FILE_TRAILER",
    width=44,
    slots=(
        Slot(5, 6, "Phase", "R ", "@phase", None),
        Slot(7, 11, "Workload ID", "L0", "@mac_id", None),
        Slot(12, 16, "MAC ID", "L0", "@mac_id", None),
        Slot(18, 26, "Total Records", "L0", "@total_records", None),
        Slot(27, 35, "Total Claim Headers", "L0", "@total_claim_headers", None),
        Slot(36, 44, "Total Claim Lines", "L0", "@total_claim_lines", None),
    ),
    constants=((1, "MAP"), (4, "T"), (17, "D")),
)

CLAIM_HEADER = Layout(
    record_type="CLAIM_HEADER",
    width=5651,
    slots=(
        Slot(4, 5, "IDR-CLM-HD-PLAN", "L0", "claim.planCode", "0"),
        Slot(6, 18, "IDR-CLM-HD-ICN-NBR", "L0", "claim.internalControlNumber", "0"),
        Slot(19, 23, "IDR-CONTR-ID", "R ", "claim.macId"),
        Slot(24, 25, "IDR-DTL-CNT", "L0", "@line_count", "0"),
        Slot(26, 37, "IDR-HIC", "R ", "payment.beneCheck.beneHicNumber"),
        Slot(40, 45, "IDR-BENE-LAST-1-6", "R ", "claim.beneficiaryLastName"),
        Slot(46, 46, "IDR-BENE-FIRST-INIT", "R ", "claim.beneficiaryFirstName"),
        Slot(48, 48, "IDR-BENE-SEX", "R ", "claim.beneficiaryGender"),
        Slot(50, 57, "IDR-STATUS-DATE", "L0", "payment.beneCheck.checkIssueDate", "0", "date"),
        Slot(67, 75, "IDR-BENE-EXCHK-NUM", "L0", "payment.beneCheck.checkNumber"),
        Slot(78, 87, "IDR-BILL-PROV-NPI", "R ", "claim.billingProviderNpi"),
        Slot(98, 107, "IDR-BILL-PROV-EI", "R ", "claim.billingProviderEin"),
        Slot(108, 109, "IDR-BILL-PROV-TYPE", "R ", "claim.billingProviderTinType"),
        Slot(119, 119, "IDR-DIAG-ICD-TYPE", "R ", "@type_by_letter"),
        Slot(120, 126, "IDR-DIAG-CODE", "R ", "@claim_diagnosis"),
        Slot(127, 127, "IDR-DIAG-ICD-TYPE", "R ", "@type_by_length"),
        Slot(128, 134, "IDR-DIAG-CODE", "R ", "@claim_diagnosis"),
        Slot(149, 155, "IDR-BENE-CHECK-AMT", "L0", "payment.beneCheck.claimAmount", "0", "number"),
        Slot(156, 162, "IDR-BENE-OFFSET", "L0", "payment.beneCheck.claimRecoupmentAmount", "0", "number"),
        Slot(172, 178, "IDR-PROV-CHECK-AMT", "L0", "payment.providerCheck.claimAmount"),
        Slot(179, 185, "IDR-PROV-OFFSET", "L0", "payment.providerCheck.claimInterestAmount", "0", "number"),
        Slot(186, 194, "IDR-PROV-EXCHK-NUM", "L0", "payment.providerCheck.checkNumber"),
        Slot(199, 205, "IDR-TOT-ALLOWED", "R ", "claim.totalAllowedAmount"),
        Slot(206, 212, "IDR-COINSURANCE", "R ", "claim.totalCoinsuranceAmount"),
        Slot(213, 219, "IDR-DEDUCTIBLE", "R ", "claim.appliedToDeductibleAmount"),
        Slot(270, 276, "IDR-TOT-BILLED-AMT", "L ", "claim.totalBilledAmount"),
        Slot(277, 284, "IDR-HHDR-FROM-DOS", "L0", "claim.serviceStartDate", "0", "date"),
        Slot(285, 292, "IDR-HDR-TO-DOS", "L0", "claim.serviceEndDate", "0", "date"),
        Slot(294, 301, "IDR-CLAIM-RECEIPT-DATE", "L0", "claim.receiptDate", "0", "date"),
        Slot(303, 352, "IDR-HDR-PROV-TAXONOMY", "R ", "claim.providerTaxonomyCode"),
        Slot(431, 434, "IDR-PHASE-SEQ-NUM", "L0", "@phase"),
        Slot(724, 730, "IDR-BENE-INT-AMT", "L0", "payment.beneCheck.claimInterestAmount", "0", "number"),
        Slot(731, 737, "IDR-PROV-INT-AMT", "L0", "payment.providerCheck.claimInterestAmount", "0", "number"),
        Slot(738, 742, "IDR-INT-RATE", "L0", "payment.interestRate", "0", "number"),
        Slot(743, 745, "IDR-CPT-DAYS", "L0", "payment.interestDaysOver", "0", "whole"),
        Slot(834, 843, "IDR-J-REFERRING-PROV-NPI", "R ", "claim.referringProviderNpi"),
        Slot(1076, 1085, "IDR-J-ORDERING-PROV-NUMB", "R ", "claim.billingProviderPtan"),
        Slot(1384, 1388, "IDR-REG-DED-REMAIN", "L0", "claim.regularDeductibleAmountMet", "0"),
        Slot(1587, 1588, "IDR-CURR-BENE-CHK-STAT", "R ", "payment.beneCheck.checkStatus"),
        Slot(1589, 1590, "IDR-CURR-PROV-CHK-STAT", "R ", "payment.providerCheck.checkStatus"),
        Slot(1591, 1598, "IDR-LAST-BENE-UPDT-DT", "L0", "payment.beneCheck.checkIssueDate", "0", "date"),
        Slot(1599, 1606, "IDR-LAST-PROV-UPDT-DT", "L0", "payment.providerCheck.checkStatusDate", "0", "date"),
        Slot(1794, 1803, "EMC-U-SUBMITTER-ID", "R ", "claim.submitterId"),
        Slot(1849, 1863, "IDR-U-OLD-CWF-ICN", "R ", "claim.internalControlNumber"),
        Slot(1864, 1878, "IDR-U-PATIENT-ACCT-N-OLD", "R ", "claim.patientControlNumber"),
        Slot(1968, 1968, "IDR-U-BENE-DNF-FLG", "R ", "payment.beneCheck.couldNotBeForwarded", "N", "yes"),
        Slot(1969, 1969, "IDR-U-PROV-DNF-FLG", "R ", "payment.providerCheck.couldNotBeForwarded", "N", "yes"),
        Slot(2856, 2864, "IDR-F-BENE-EXT-EOB", "R ", "payment.beneCheck.higlasClaimCheckNumber"),
        Slot(2865, 2871, "IDR-F-BENE-PAY-AMT", "L0", "claim.patientPaidAmount", "0"),
        Slot(2889, 2897, "IDR-F-PROV-EXT-EOB", "R ", "payment.providerCheck.higlasClaimCheckNumber"),
        Slot(2944, 2950, "IDR-F-BENE-PAY-AMT", "L0", "claim.patientPaidAmount", "0"),
        Slot(5087, 5097, "IDR-CLAIM-MBI", "R ", "claim.medicareBeneficiaryIdentifier"),
    ),
    zeros="""
        2-3 58-66 138-140 423-430 445-452 455-457 460-462 465-467 470-472
        475-477 480-482 484-491 494-496 499-501 504-506 509-511 514-516 519-521
        523-530 533-535 538-540 543-545 548-550 553-555 558-560 562-569 572-574
        577-579 582-584 587-589 592-594 597-599 610-705 749-751 754-756 759-761
        764-766 769-771 774-776 779-781 784-786 789-791 794-796 799-801 804-806
        809-813 879-881 883-889 1086-1101 1125-1132 1141-1148 1157-1164
        1173-1180 1189-1196 1205-1212 1221-1228 1237-1244 1253-1260 1269-1276
        1285-1292 1304-1310 1335-1342 1344-1351 1353-1360 1362-1369 1371-1378
        1383 1389-1402 1404-1408 1425-1432 1437-1456 1458-1462 1479-1486
        1491-1510 1512-1516 1533-1540 1545-1564 1566-1570 1610-1617 1619-1629
        1638-1645 1650-1657 1662-1669 1674-1681 1686-1693 1698-1705 1710-1724
        1752-1767 1778-1793 1930-1951 1955-1967 2026-2033 2051-2061 2081-2088
        2105-2112 2129-2136 2153-2160 2177-2184 2203-2209 2221-2228 2247-2253
        2265-2272 2291-2297 2309-2316 2335-2341 2353-2360 2379-2385 2397-2404
        2423-2429 2441-2448 2467-2473 2485-2492 2511-2517 2529-2536 2555-2561
        2573-2580 2599-2605 2617-2624 2643-2649 2661-2668 2687-2693 2705-2712
        2731-2737 2749-2756 2775-2781 2793-2800 2819-2825 2837-2844 2872-2878
        2898-2911 2916-2923 2951-2957 2977-2990 2995-3002 3008-3023 3025-3032
        3068-3075 3090-3105 3107-3114 3150-3157 3172-3187 3189-3196 3232-3239
        3254-3269 3271-3278 3314-3321 3336-3351 3353-3360 3396-3403 3418-3433
        3435-3442 3478-3485 3500-3515 3517-3524 3560-3567 3582-3597 3599-3606
        3642-3649 3664-3679 3681-3688 3724-3731 3746-3761 3763-3770 3806-3813
        3823-3830 3865-3894 3929-3958 3993-4022 4057-4086 4121-4150 4185-4214
        4249-4278 4313-4342 4377-4406 4441-4470 4505-4534 4569-4598 4633-4662
        4697-4726 4761-4790 4825-4854 4889-4910
    """,
    constants=((1, "B"),),
)

CLAIM_LINE = Layout(
    record_type="CLAIM_LINE",
    width=2332,
    slots=(
        Slot(2, 3, "IDR-CLM-DT-REC-TYPE", "L0", "@line_sequence"),
        Slot(6, 18, "IDR-CLM-DT-ICN", "L0", "line.internalControlNumber", "0"),
        Slot(19, 20, "IDR-DTL-NUMBER", "L0", "line.serviceLineNumber", "0"),
        Slot(29, 36, "IDR-DTL-FROM-DATE", "L0", "line.cmsServiceDate", "0", "spaced date"),
        Slot(47, 47, "IDR-TOS", "R ", "line.healthCareServiceLocationFacilityCode", " "),
        Slot(48, 52, "IDR-PROC-CODE", "R ", "line.healthcareCommonProcedureCode", " "),
        Slot(53, 54, "IDR-MOD-ONE", "R ", "line.healthcareCommonProcedureCodeModifiers", " "),
        Slot(55, 56, "IDR-MOD-TWO", "R ", "line.healthcareCommonProcedureCodeModifiers", " "),
        Slot(57, 58, "IDR-MOD-THREE", "R ", "line.healthcareCommonProcedureCodeModifiers", " "),
        Slot(59, 60, "IDR-MOD-FOUR", "R ", "line.healthcareCommonProcedureCodeModifiers", " "),
        Slot(81, 87, "IDR-DTL-ALLOWED", "L0", "line.billedAmount", "0"),
        Slot(88, 94, "IDR-DTL-PAID", "L0", "line.allowedAmount", "0"),
        Slot(211, 211, "IDR-PERF-PROV-ST", "R ", "@participation"),
        Slot(214, 214, "IDR-DTL-DIAG-ICD-TYPE", "R ", "@line_type_by_letter"),
        Slot(215, 221, "IDR-DTL-PRIMARY-DIAG-CODE", "R ", "@claim_diagnosis", " "),
        Slot(306, 312, "IDR-DTL-PROV-PAID", "L0", "line.paidToProviderAmount", "0"),
        Slot(313, 319, "IDR-DTL-BENE-PAID", "L0", "line.paidToBeneficiaryAmount", "0"),
        Slot(321, 325, "IDR-DTL-REG-DED", "L0", "line.appliedToDeductibleAmount", "0"),
        Slot(384, 390, "IDR-DTL-MSP-CUTBACK", "L0", "line.coinsuranceAmount", "0"),
        Slot(391, 397, "IDR-DTL-LATE-RED", "L0", "line.cutbackAmounts", "0", "json"),
        Slot(398, 407, "IDR-DTL-REND-NPI", "R ", "line.renderingProviderNpi"),
        Slot(408, 417, "IDR-DTL-REND-PROV", "R ", "line.renderingProviderPtan"),
        Slot(426, 427, "IDR-DTL-REND-SPEC", "R ", "line.renderingProviderSpecialtyCode"),
        Slot(921, 937, "IDR-K-LN-ITEM-CTL-N", "R ", "line.providerServiceLineId"),
        Slot(1109, 1168, "IDR-K-POS-LNAME-ORG", "R ", "line.serviceFacilityLocationLastOrOrganizationName"),
        Slot(1229, 1283, "IDR-K-POS-ADDR1", "R ", "line.serviceFacilityLocationAddressLine1"),
        Slot(1339, 1368, "IDR-K-POS-CITY", "R ", "line.serviceFacilityLocationCity"),
        Slot(1369, 1370, "IDR-K-POS-STATE", "R ", "line.serviceFacilityLocationState"),
        Slot(1371, 1385, "IDR-K-POS-ZIP", "R ", "line.serviceFacilityLocationZipCode"),
    ),
    zeros="""
        4-5 37-46 64-80 103-121 128 173-181 222-227 264-280 282-288 320 326-346
        349-383 428-448 454-460 470-478 480-506 606-620 628-630 649-652 673-675
        686-688 690-696 698-700 702-708 710-712 714-723 725-731 736-745 748-750
        753-755 758-760 763-765 768-770 773-775 778-780 783-785 788-790 793-795
        798-800 807-809 815-822 827-834 839-846 851-858 863-870 875-889 938-968
        1005-1013 1023-1028 1036 1064-1066 1068-1107 1389-1401 1407-1460
        1482-1490 1571-1582 1584-1586 1588-1596 1600-1611 1616-1618 1623-1625
        1630-1632 1637-1639 1644-1655 1668-1676 1680-1688 2050-2052 2054-2062
        2066-2068 2073-2075 2077-2085 2089-2091 2096-2155 2160-2167 2172-2174
        2178-2180 2182-2190 2196-2198 2203-2211 2214-2222 2225-2233 2236-2244
        2247-2255 2258-2266 2269-2277 2280-2282 2287-2289 2294-2307 2309-2325
    """,
    constants=((1, "B"),),
)

LAYOUTS = (FILE_HEADER, CLAIM_HEADER, CLAIM_LINE, FILE_TRAILER)
