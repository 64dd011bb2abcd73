"""The report registry: one ``ReportSpec`` per delivered report file.

Fixed values: table names, column names, source headers and export labels are
the report contracts (what the delivered files contain and what the target
tables and readable exports must look like).
"""

from __future__ import annotations

from reportflow.spec import ReportSpec, Registry, columns

REGISTRY = Registry()
add = REGISTRY.add

# --- NETWORKS -----------------------------------------------------------------

PARENT = add(ReportSpec("NETWORKS", "2G_BSC_List.csv", "huawei_parent", columns("""
name | bsc_name | BSC Name
osp_code | osp_code[whole_number] | OSP code[Whole Number]
sw | nedspver | NeDspVer
oss | * | Area
update_date | * | -
"""), key="name", side_files=("3G_RNC_List.csv",)))

SITE_2G = add(ReportSpec("NETWORKS", "2G_Site_List.csv", "huawei_2g_site", columns("""
unique_id | * | -
bts_index | bts_index | BTS Index
bts_name | bts_name | BTS Name
numb_name | * | SiteId
bts_type | bts_type | BTS Type
serv_type | service_type | Service Type
status | active_status | Active Status
bts_software_version | * | BTS Software Version 1
parent | bsc_name | BSC Name
sran | * | SRAN
oss | * | Area
update_date | * | -
"""), export_order=("BSC Name", "BTS Name", "BTS Index", "BTS Type", "Service Type",
                    "Active Status", "SRAN", "BTS Software Version 1", "Area", "SiteId"),
    side_files=("CO-MPT 2G.csv",)))

CELL_2G = add(ReportSpec("NETWORKS", "2G_Cell_List.csv", "huawei_2g_cell", columns("""
unique_id | * | -
index | cell_index | Cell Index
cgi | * | CGI
name | cell_name | Cell Name
freq | freq_band | Freq. Band
mcc | mcc | MCC
mnc | mnc | MNC
lac | cell_lac | Cell LAC
ci | cell_ci | Cell CI
ncc | ncc | NCC
bcc | bcc | BCC
rac | routing_area | Routing Area
bts_index | bts_index | BTS Index
bts_name | bts_name | BTS Name
name_numb | * | -
state | administrative_state | Administrative State
active | active_status | active status
operator | operator_name | Operator Name
parent | bsc_name | BSC Name
local_cell_id | local_cell_id | Local Cell ID
oss | * | Area
update_date | * | -
"""), export_order=("BSC Name", "BTS Name", "Cell Name", "Cell Index", "Freq. Band", "MCC", "MNC",
                    "Cell LAC", "Cell CI", "NCC", "BCC", "BTS Index", "Administrative State",
                    "active status", "Operator Name", "Routing Area", "Local Cell ID", "CGI",
                    "Area")))

TRX_2G = add(ReportSpec("NETWORKS", "2G_Cell_TRX.csv", "huawei_2g_trx", columns("""
unique_id | * | -
parent | bsc_name | BSC Name
bts_name | bts_name | BTS Name
bsc_cell_name | cell_name | Cell Name
bsc_cell_index | cell_index | BSC Cell Index
cell_index | cell_index1 | Cell Index
main_bcch | is_main_bcch_trx | Is Main BCCH TRX
freq | frequency | Frequency
number | trx_no | TRX No.
trx_id | trx_id | TRX ID
active_status | active_status | Active Status
admin_status | administrative_state | Administrative State
oss | * | Area
update_date | * | -
name | trx_name | TRX Name
"""), export_order=("BSC Name", "BTS Name", "Cell Name", "BSC Cell Index", "Cell Index",
                    "Is Main BCCH TRX", "Frequency", "TRX No.", "TRX ID", "Active Status",
                    "Administrative State", "TRX Name", "Area")))

SITE_3G = add(ReportSpec("NETWORKS", "3G_Site_List.csv", "huawei_3g_site", columns("""
unique_id | * | -
name | nodeb_name | NodeB Name
numb | * | SiteId
index | nodeb_id | NodeB ID
subrack_no | subrack_no | Subrack No.
slot_no | slot_no | Slot No.
subsystem_no | subsystem_no | Subsystem No.
iub_transport | iub_transport_bearer_type | IUB Transport Bearer Type
sharing_type | sharing_type_of_nodeb | Sharing Type Of NodeB
state | administrative_state | Administrative state
nodeb_ip_trans_ip_address | nodeb_ip_trans_ip_address | NodeB IP_TRANS IP address
nodeb_ip_trans_ip_mask | nodeb_ip_trans_ip_mask | NodeB IP_TRANS IP Mask
nodeb_ip_trans_subrack_no | nodeb_ip_trans_subrack_no | NodeB IP_TRANS Subrack No.
nodeb_ip_trans_slot_no | nodeb_ip_trans_slot_no | NodeB IP_TRANS Slot No.
nodeb_atm_trans_ip_address | nodeb_atm_trans_ip_address | NodeB ATM_TRANS IP address
nodeb_atm_trans_ip_mask | nodeb_atm_trans_ip_mask | NodeB ATM_TRANS IP Mask
nodeb_atm_trans_subrack_no | nodeb_atm_trans_subrack_no | NodeB ATM_TRANS Subrack No.
nodeb_atm_trans_slot_no | nodeb_atm_trans_slot_no | NodeB ATM_TRANS Slot No.
parent | bsc_name | BSC Name
software | * | Software
cabinet | * | Cabinet Type
sran_name | * | SRAN
oss | * | Area
update_date | * | -
"""), export_order=("BSC Name", "NodeB Name", "NodeB ID", "Subrack No.", "Slot No.",
                    "Subsystem No.", "IUB Transport Bearer Type", "Sharing Type Of NodeB",
                    "Administrative state", "NodeB IP_TRANS IP address", "NodeB IP_TRANS IP Mask",
                    "NodeB IP_TRANS Subrack No.", "NodeB IP_TRANS Slot No.",
                    "NodeB ATM_TRANS IP address", "NodeB ATM_TRANS IP Mask",
                    "NodeB ATM_TRANS Subrack No.", "NodeB ATM_TRANS Slot No.", "Software",
                    "Cabinet Type", "SRAN", "Area", "SiteId"),
    side_files=("CO-MPT 3G.csv", "NodeB Info.csv")))

CELL_3G = add(ReportSpec("NETWORKS", "3G_Cell_List.csv", "huawei_3g_cell", columns("""
unique_id | * | -
cgi | * | CGI
cell_id | cell_id | Cell ID
name | cell_name | Cell Name
max_power | max_transmit_power_of_cell | Max Transmit Power of Cell
band | band_indicator | Band Indicator
uplink | uplink_uarfcn | Uplink UARFCN
downlink | downlink_uarfcn | Downlink UARFCN
offset | time_offset | Time Offset
dl_primary_sc | dl_primary_scrambling_code | DL Primary Scrambling Code
site_name | nodeb_name | NodeB Name
local_cell_id | local_cell_id | Local Cell ID
lac | location_area_code | Location Area Code
sac | service_area_code | Service Area Code
rac_indi | rac_configuration_indication | RAC Configuration Indication
rac | routing_area_code | Routing Area Code
subrack_no | subrack_no | Subrack No.
slot_no | slot_no | Slot No.
val_ind | validation_indication | Validation indication
state | cell_administrative_state | Cell administrative state
parent | bsc_name | BSC Name
cn_opt_index | cn_operator_index | Cn Operator Index
cn_opt_gr_index | cn_operator_group_index | Cn Operator Group Index
cn_operator_name | cn_operator_name | Cn Operator Name
mnc | mobile_network_code | Mobile network code
mcc | mobile_country_code | Mobile country code
oss | * | Area
update_date | * | -
"""), export_order=("BSC Name", "NodeB Name", "Cell Name", "Max Transmit Power of Cell",
                    "Band Indicator", "Cell ID", "Downlink UARFCN", "Uplink UARFCN", "Time Offset",
                    "DL Primary Scrambling Code", "Local Cell ID", "Location Area Code",
                    "Service Area Code", "RAC Configuration Indication", "Routing Area Code",
                    "Cell administrative state", "Subrack No.", "Slot No.",
                    "Validation indication", "Cn Operator Group Index", "Mobile country code",
                    "Mobile network code", "Cn Operator Index", "Cn Operator Name", "Area")))

SITE_4G = add(ReportSpec("NETWORKS", "4G_Site_List.csv", "huawei_4g_site", columns("""
unique_id | * | -
name | ne_name | eNodeB Function Name
type | cabinet_type | Cabinet Type
sw | * | Software Version
number | * | SiteId
enodeb_id | enodeb_id | eNodeB ID
sran_name | * | SRAN
oss | * | Area
update_date | * | -
"""), export_order=("NE Name", "Cabinet Type", "Software Version", "eNodeB ID",
                    "eNodeB Function Name", "SRAN", "Area", "SiteId"),
    side_files=("CO-MPT 4G.csv",)))

CELL_4G = add(ReportSpec("NETWORKS", "4G_Cell_List.csv", "huawei_4g_cell", columns("""
unique_id | * | -
ecgi | * | ECGI
local_id | local_cell_id | Local Cell ID
name | cell_name | Cell Name
freq_band | frequency_band | Frequency band
ul_earfcn | uplink_earfcn | Uplink EARFCN
dl_earfcn | downlink_earfcn | Downlink EARFCN
cell_id | cell_id | Cell ID
pci | physical_cell_id | Physical cell ID
mcc | mobile_country_code | Mobile country code
mnc | mobile_network_code | Mobile network code
operator_name | cn_operator_name | CN Operator name
active_state | cell_active_state | Cell active state
admin_state | cell_admin_state | Cell admin state
ne | ne_name | NE Name
cell_fdd_tdd_indication | cell_fdd_tdd_indication | Cell FDD TDD indication
uplink_bandwidth | uplink_bandwidth | Uplink bandwidth
downlink_bandwidth | downlink_bandwidth | Downlink bandwidth
custom_bw_conf_inf | customized_bandwidth_configure_indicator | Customized bandwidth configure indicator
customi_uplink_bw | customized_uplink_bandwidth(01mhz) | Customized uplink bandwidth(0.1MHz)
custom_downlink_bw | customized_downlink_bandwidth(01mhz) | Customized downlink bandwidth(0.1MHz)
downlink_punct_rb_numb | downlink_punctured_rb_number | Downlink Punctured RB Number
tac | tracking_area_code | Tracking area code
enodb_id | enodeb_id | eNodeB ID
enodb_function_name | enodeb_function_name | eNodeB Function Name
oss | * | Area
update_date | * | -
rsi | root_sequence_index | Root sequence index
"""), export_order=("NE Name", "Local Cell ID", "Cell Name", "Frequency band", "Uplink EARFCN",
                    "Downlink EARFCN", "Cell ID", "Physical cell ID", "Cell active state",
                    "Cell admin state", "Cell FDD TDD indication", "Uplink bandwidth",
                    "Downlink bandwidth", "Customized bandwidth configure indicator",
                    "Customized uplink bandwidth(0.1MHz)", "Customized downlink bandwidth(0.1MHz)",
                    "Downlink Punctured RB Number", "Tracking area code", "Mobile country code",
                    "Mobile network code", "CN Operator name", "eNodeB ID", "eNodeB Function Name",
                    "ECGI", "Root sequence index", "Area"),
    side_files=("CO-MPT 4G_Cell_List.csv",)))

SITE_5G = add(ReportSpec("NETWORKS", "5G_Site_List.csv", "huawei_5g_site", columns("""
unique_id | * | -
name | ne_name | NE Name
type | cabinet_type | Cabinet Type
sw | * | Software Version
number | * | SiteId
gnodeb_id | gnodeb_id | gNodeB ID
oss | * | Area
update_date | * | -
"""), export_order=("NE Name", "Cabinet Type", "Software Version", "gNodeB ID", "Area",
                    "SiteId")))

CELL_5G = add(ReportSpec("NETWORKS", "5G_Cell_List.csv", "huawei_5g_cell", columns("""
unique_id | * | -
ncgi | * | NCGI
ne_name | ne_name | NE Name
nr_cell_id | nr_cell_id | NR Cell ID
cell_name | cell_name | Cell Name
cell_id | cell_id | Cell ID
freq_band | frequency_band | Frequency Band
duplex_mode | duplex_mode | Duplex Mode
user_label | user_label | User Label
active_state | cell_activate_state | Cell Activate State
nr_du_cell_id | nr_du_cell_id | NR DU Cell ID
nr_du_cell_name | nr_du_cell_name | NR DU Cell Name
physical_cell_id | physical_cell_id | Physical Cell ID
up_narfcn | uplink_narfcn | Uplink NARFCN
down_narfcn | downlink_narfcn | Downlink NARFCN
up_bandwidth | uplink_bandwidth | Uplink Bandwidth
down_bandwidth | downlink_bandwidth | Downlink Bandwidth
radius | cell_radius(m) | Cell Radius(m)
subcarrier_spacing | subcarrier_spacing(khz) | Subcarrier Spacing(KHz)
cyclic_prefix_length | cyclic_prefix_length | Cyclic Prefix Length
slot_assignment | slot_assignment | Slot Assignment
slot_structure | slot_structure | Slot Structure
ran_notification_area_id | ran_notification_area_id | RAN Notification Area ID
lampsite_flag | lampsite_cell_flag | LampSite Cell Flag
tracking_area | tracking_area_id | Tracking Area ID
ta_offset | ta_offset | TA Offset
admin_state | cell_administration_state | Cell Administration State
ssb_freq_posi_describe_method | ssb_frequency_position_describe_method | SSB Frequency Position Describe Method
ssb_freq_postion | ssb_frequency_position | SSB Frequency Position
ssb_period | ssb_period(ms) | SSB Period(ms)
ssb1_period | sib1_period(ms) | SIB1 Period(ms)
logical_root_sequence_index | logical_root_sequence_index | Logical Root Sequence Index
prach_freq_start_position | prach_frequency_start_position | PRACH Frequency Start Position
tracking_area_code | tracking_area_code | Tracking Area Code
gnodeb_id | gnodeb_id | gNodeB ID
gnodeb_name | gnodeb_function_name | -
oss | * | Area
update_date | * | -
"""), export_order=("NE Name", "NR Cell ID", "Cell Name", "Cell ID", "Frequency Band",
                    "Duplex Mode", "User Label", "Cell Activate State", "NR DU Cell ID",
                    "NR DU Cell Name", "Physical Cell ID", "Uplink NARFCN", "Downlink NARFCN",
                    "Uplink Bandwidth", "Downlink Bandwidth", "Cell Radius(m)",
                    "Subcarrier Spacing(KHz)", "Cyclic Prefix Length", "Slot Assignment",
                    "Slot Structure", "RAN Notification Area ID", "LampSite Cell Flag",
                    "Tracking Area ID", "TA Offset", "Cell Administration State",
                    "SSB Frequency Position Describe Method", "SSB Frequency Position",
                    "SSB Period(ms)", "SIB1 Period(ms)", "Logical Root Sequence Index",
                    "PRACH Frequency Start Position", "Tracking Area Code", "gNodeB ID", "NCGI",
                    "Area")))

# NodeB Info is allow-listed as a NETWORKS file and exported raw (no table).
NODEB_INFO = "NodeB Info.csv"
NETWORK_FILES = ("2G_BSC_List.csv", NODEB_INFO, "3G_Cell_List.csv", "2G_Cell_List.csv",
                 "5G_Cell_List.csv", "2G_Cell_TRX.csv", "5G_Site_List.csv", "3G_Site_List.csv",
                 "2G_Site_List.csv", "4G_Site_List.csv", "4G_Cell_List.csv")

# --- EXTERNALS ----------------------------------------------------------------

EXT_2G_2G = add(ReportSpec("EXTERNALS", "2G - External 2G (GEXT2GCELL).csv", "huawei_2g_ext_to_2g",
                           columns("""
cgi | * | -
parent | bsc_name | BSC Name
cell_index | cell_index | Cell Index
cell_name | cell_name | Cell Name
mnc | mnc | MNC
mcc | mcc | MCC
lac | cell_lac | Cell LAC
ci | cell_ci | Cell CI
bcch_fd | bcch_fd | BCCH FD
ncc | ncc | NCC
bcc | bcc | BCC
rac | rac | RAC
oss | * | OSS
unique_id | * | -
update_date | * | -
""")))

EXT_2G_3G = add(ReportSpec("EXTERNALS", "2G - External 3G (GEXT3GCELL).csv", "huawei_2g_ext_to_3g",
                           columns("""
cgi | * | -
parent | bsc_name | BSC Name
cell_id | cell_index | Cell Index
cell_name | cell_name | Cell Name
mcc | mcc | MCC
mnc | mnc | MNC
lac | cell_lac | Cell LAC
cell_ci | cell_ci | Cell CI
parent_id | rnc_id | RNC ID
neighboring_rnc_id | neighboring_rnc_index | Neighboring RNC Index
layer_of_cell | layer_of_the_cell | Layer of the cell
dl_uarfcn | dl_uarfcn | DL UARFCN
scrambling_code | scrambling_code_or_cell_parameter_id | Scrambling Code
rac | route_area | Cell RAC
oss | * | OSS
unique_id | * | -
update_date | * | -
""")))

EXT_2G_4G = add(ReportSpec("EXTERNALS", "2G - External 4G (GEXTLTECELL).csv", "huawei_2g_ext_to_4g",
                           columns("""
ecgi | * | -
parent | bsc_name | -
cell_index | cell_index | -
cell_name | cell_name | -
mcc | mcc | -
mnc | mnc | -
enodeb_type | enodeb_type | -
cell_ci | cell_ci | -
cell_tac | cell_tac | -
earfcn | earfcn | -
pci | physical_cell_id | -
eutran_cell_type | eutran_cell_type | -
opt_name | operator_name | -
sharing_opt_index | sharing_operator_group_index | -
oss | * | -
unique_id | * | -
update_date | * | -
"""), export_labels=False))

EXT_3G_2G = add(ReportSpec("EXTERNALS", "3G - External 2G (UEXT2GCELL).csv", "huawei_3g_ext_to_2g",
                           columns("""
cgi | * | -
parent | bsc_name | RNC Name
gsm_cell_index | gsm_cell_index | GSM Cell Index
gsm_cell_name | gsm_cell_name | GSM Cell Name
neighboring_bsc_id | neighboring_bsc_index | Neighboring BSC Index
mcc | mobile_country_code | MCC
mnc | mobile_network_code | MNC
cn_opt_index | cn_operator_group_index | CN Operator Index
lac | location_area_code | LAC
rac | routing_area_code | RAC
gsm_cell_id | gsm_cell_id | GSM Cell ID
ncc | network_color_code | NCC
bcc | bs_color_code | BCC
inter_rat_cell_freq | inter-rat_cell_frequency_number | Inter-RAT Cell Frequency Number
inter_rat_cell_freq_band | inter-rat_cell_frequency_band_indicator | Inter-RAT Cell Frequency Band Indicator
node_id | node_id | Node ID
unique_id | * | -
oss | * | OSS
update_date | * | -
""")))

EXT_3G_3G = add(ReportSpec("EXTERNALS", "3G - External 3G (UEXT3GCELL).csv", "huawei_3g_ext_to_3g",
                           columns("""
cgi | * | -
parent | bsc_name | RNC Name
neighbouring_rnc_id | neighboring_rnc_id | Neighboring RNC ID
cell_id_neighbouring_rnc | cell_id_of_neighboring_rnc | Cell ID of Neighboring RNC
cell_name | cell_name | Cell Name
cn_opt_index | cn_operator_group_index | CN Operator Index
dl_primary_sc | dl_primary_scrambling_code | DL Primary Scrambling Code
band_indicator | band_indicator | Band Indicator
ul_freq_ind | ul_frequency_ind | UL Frequency Ind
ul_uarfcn | uplink_uarfcn | Uplink UARFCN
dl_uarfcn | downlink_uarfcn | Downlink UARFCN
lac | location_area_code | LAC
rac | routing_area_code | RAC
node_id | node_id | Node ID
mnc | mobile_network_code | MNC
mcc | mobile_country_code | MCC
cn_operator_name | cn_operator_name | Cn Operator Name
oss | * | OSS
unique_id | * | -
update_date | * | -
""")))

EXT_3G_4G = add(ReportSpec("EXTERNALS", "3G - External 4G (ULTECELL).csv", "huawei_3g_ext_to_4g",
                           columns("""
ecgi | * | -
parent | bsc_name | -
lte_cell_index | lte_cell_index | -
lte_cell_name | lte_cell_name | -
lte_cell_identity | eutran_cell_identity | -
mcc | mobile_country_code | -
mnc | mobile_network_code | -
tac | tracking_area_code | -
opt_group_index | operator_group_index | -
lte_pci | lte_physical_cell_identity | -
lte_cell_freq_band | lte_cell_frequency_band | -
lte_cell_dl_freq | lte_cell_downlink_frequency | -
lte_cell_sup_ps_ho | lte_cell_supporting_ps_ho_indicator | -
blackcell_lst | blackcell_list_flag | -
cn_opt_index_rout_u2l_rim | cn_operator_index_for_routing_in_u2l_rim | -
oss | * | -
unique_id | * | -
update_date | * | -
"""), export_labels=False))

# Key parts per external report: (cgi/ecgi parts, unique_id parts), source headers.
EXTERNAL_KEYS = {
    EXT_2G_2G.file_name: ("cgi", ("mcc", "mnc", "cell_lac", "cell_ci"), ("bsc_name", "cell_index")),
    EXT_2G_3G.file_name: ("cgi", ("mcc", "mnc", "cell_lac", "cell_ci"), ("bsc_name", "cell_index")),
    EXT_2G_4G.file_name: ("ecgi", ("mcc", "mnc", "cell_ci", "physical_cell_id"),
                          ("bsc_name", "cell_index")),
    EXT_3G_2G.file_name: ("cgi", ("mobile_country_code", "mobile_network_code",
                                  "location_area_code", "gsm_cell_id"),
                          ("bsc_name", "gsm_cell_name")),
    EXT_3G_3G.file_name: ("cgi", ("mobile_country_code", "mobile_network_code",
                                  "location_area_code", "cell_id_of_neighboring_rnc"),
                          ("bsc_name", "neighboring_rnc_id", "cell_id_of_neighboring_rnc")),
    EXT_3G_4G.file_name: ("ecgi", ("mobile_country_code", "mobile_network_code",
                                   "eutran_cell_identity", "lte_physical_cell_identity"),
                          ("bsc_name", "lte_cell_index")),
}

# --- PKI, command logs ------------------------------------------------------------

PKI = add(ReportSpec("PKI", "*", "pki_project", columns("""
site_name | site_name | site_name
ca_name | ca_name | ca_name
certificate_date | certificate_date | certificate_date
certificate_expiration_date | certificate_expiration_date | certificate_expiration_date
s1_secgw | s1_secgw | s1_secgw
s1_secgw_ip | s1_secgw_ip | s1_secgw_ip
x2_secgw | x2_secgw | x2_secgw
x2_secgw_ip | x2_secgw_ip | x2_secgw_ip
certificate_file_name | certificate_file_name | certificate_file_name
certificate_common_name | certificate_common_name | certificate_common_name
certificate_serial_number | certificate_serial_number | certificate_serial_number
oss | oss | oss
site_type | type | site_type
insert_time | * | insert_time
"""), key="site_name", preamble=0, scope="all", sort_col="insert_time", export_labels=False))

COMMAND_LOG = add(ReportSpec("HCMD", "*_*.csv", "huawei_log", columns("""
source | source | -
operator | operator_name | -
dn | dn | -
ip | ip_address | -
cmd_code | command_code | -
opr_type | command_type | -
start_time | operation_time | -
return_code | return_code | -
result | result | -
end_time | operation_end_time | -
org_cmd | operation_command | -
cmd | * | -
cmd_type | * | -
opr_code | * | -
bsc | * | -
insert_time | * | -
"""), key="", preamble=2, footer=1, scope="append", export_labels=False))

# Report families and their gate comparison (see operators.gates).
FAMILIES = ("NETWORKS", "EXTERNALS", "HCMD", "PKI", "WEEKPLAN")
