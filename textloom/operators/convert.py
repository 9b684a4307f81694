"""Raw feeds to instruction examples. Templates and defaults are fixed values of the output format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import clean_markdown, or_empty, strip

TECHNIQUE = """### Technique Overview
- **Identifier**: {id} ({name})
- **Tactic Category**: {tactics}
- **Applicable Platforms**: {platforms}

### Technical Mechanics & Attacker Behavior
{description}

### Detection Methods & Telemetry
{detection}

### Defensive Controls & Mitigation Strategy
1. **Auditing & Logging**: Enable high-fidelity event logging (Sysmon, EDR agent, Windows Event ID 4688 / PowerShell Script Block ID 4104).
2. **Access Controls**: Apply principle of least privilege; restrict administrative token elevation and service execution.
3. **Network & Endpoint Hardening**: Enforce application allowlisting (AppLocker / WDAC) and isolate critical endpoints."""
VULNERABILITY = """### Vulnerability Analysis & Technical Breakdown
- **CVE Identifier**: {id}
- **Affected Target**: {vendor} - {product}
- **Vulnerability Classification**: {name} ({cwes})

### Exploitation Mechanics & Attack Vector
{description}
- **In-the-Wild Status**: Actively exploited in real-world attacks.
- **Ransomware Association**: {ransomware}

### Detection & Log Indicators
1. Check access and authentication logs for anomalous requests matching known {id} PoC signatures.
2. Monitor perimeter gateway traffic and application access logs for anomalous payload bursts.

### Mitigation & Secure Remediation
- **Mandatory Action**: {action}
- **Patch Management**: Immediately apply official vendor security hotfixes and isolate exposed instances behind a zero-trust gateway.
- **Defensive Hardening**: Implement strict network segmentation and validate all user-supplied input at application boundaries."""
MALWARE = """### Threat Profile: {family}
- **Primary Actor**: {actor}
- **MITRE ATT&CK Mapping**: {techniques}

### Infection Lifecycle & Execution Behavior
1. **Initial Access**: {access}
2. **Execution Vector**: {execution}
3. **Defense Evasion**: {evasion}

### Indicators of Compromise (IoCs)
- **SHA-256 Hashes**: `{sha256}`
- **Registry Artifacts**: `{registry_keys}`
- **Network / C2 Infrastructure**: `{network_domains}`

### Detection & Threat Hunting Strategy
- **YARA / EDR Rule Focus**: Match on unique unpacked string signatures and process execution arguments.
- **Event Log Indicators**: Monitor for shadow copy deletion commands (`vssadmin`) and abnormal credential dumping activity.

### Containment & Eradication
{remediation}"""
ARTICLE = """### Overview & Attack Scenario
{opening}...

### Prevention & Defensive Controls
1. **Input Validation & Parameterization**: Never concatenate user input directly into executable contexts (SQL, OS commands, LDAP).
2. **Access Control Verification**: Enforce server-side role-based access control (RBAC) on every request; deny by default.
3. **Defense in Depth**: Implement Content Security Policy (CSP), automated dependency auditing, and centralized error handling."""


def fill(template: str, **parts: Column) -> Column:
    """The template with {name} replaced by columns."""
    out, rest = [], template
    while "{" in rest:
        text, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(text), or_empty(parts[name])]
    return F.concat(*out, F.lit(rest))


def _example(rows: DataFrame, instruction: str, input_: Column, output: Column, category: str, source: str, difficulty: Column) -> DataFrame:
    return rows.select(F.lit(instruction).alias("instruction"), input_.alias("input"), output.alias("output"), F.lit(category).alias("category"), F.lit(source).alias("source"), difficulty.alias("difficulty"))


def _has(text: Column, *words: str) -> Column:
    found = F.lower(text).contains(words[0])
    for w in words[1:]:
        found = found | F.lower(text).contains(w)
    return found


def techniques(objects: DataFrame) -> DataFrame:
    """STIX objects (a row each: type, revoked, name, description, external_references, x_mitre_platforms, kill_chain_phases, x_mitre_detection) to examples."""
    refs = F.filter("external_references", lambda r: r["source_name"] == "mitre-attack")
    rows = objects.where((F.col("type") == "attack-pattern") & ~F.coalesce("revoked", F.lit(False)))
    rows = rows.select(
        or_empty(F.col("name")).alias("name"), clean_markdown(F.col("description")).alias("description"), or_empty(F.get(refs, F.lit(0))["external_id"]).alias("id"),
        F.when(F.col("x_mitre_platforms").isNull(), "All").otherwise(F.array_join("x_mitre_platforms", ", ")).alias("platforms"),
        F.when(F.coalesce(F.size("kill_chain_phases"), F.lit(0)) > 0, F.array_join(F.transform("kill_chain_phases", lambda k: k["phase_name"]), ", ")).otherwise("Execution / Persistence").alias("tactics"),
        F.when(F.col("x_mitre_detection").isNull(), "Monitor command execution logs, API calls, and authentication events.").otherwise(clean_markdown(F.col("x_mitre_detection"))).alias("detection"),
    ).where("id != '' AND description != ''")
    c = {n: F.col(n) for n in rows.columns}
    input_ = fill("Technique ID: {id}\nTechnique Name: {name}\nTactics: {tactics}\nPlatforms: {platforms}\nDescription: {short}...", short=F.substring("description", 1, 400), **c)
    hard = F.when(_has(c["description"], "kernel", "injection", "bypass"), "advanced").otherwise("intermediate")
    return _example(rows, "Explain this attack technique.", input_, fill(TECHNIQUE, **c), "threat_intelligence", "mitre_attack", hard)


def vulnerabilities(entries: DataFrame) -> DataFrame:
    """Catalogue entries (cveID, vendorProject, product, vulnerabilityName, shortDescription, requiredAction, knownRansomwareCampaignUse, cwes) to examples."""
    rows = entries.select(
        or_empty(F.col("cveID")).alias("id"), F.coalesce("vendorProject", F.lit("Unknown")).alias("vendor"), F.coalesce("product", F.lit("Unknown")).alias("product"), or_empty(F.col("vulnerabilityName")).alias("name"),
        clean_markdown(F.col("shortDescription")).alias("description"), clean_markdown(F.coalesce("requiredAction", F.lit("Apply vendor updates according to instructions."))).alias("action"),
        F.coalesce("knownRansomwareCampaignUse", F.lit("Unknown")).alias("ransomware"),
        F.when(F.coalesce(F.size("cwes"), F.lit(0)) > 0, F.array_join("cwes", ", ")).otherwise("General Vulnerability (CWE-Top25)").alias("cwes"),
    ).where("id != '' AND description != ''")
    c = {n: F.col(n) for n in rows.columns}
    input_ = fill("CVE: {id}\nAffected Software: {vendor} {product}\nVulnerability Name: {name}\nCWE: {cwes}\nDescription: {description}", **c)
    hard = F.when(_has(c["name"], "rce") | _has(c["description"], "overflow", "injection"), "advanced").otherwise("intermediate")
    return _example(rows, "Analyze this vulnerability and explain exploitation and remediation.", input_, fill(VULNERABILITY, **c), "vulnerabilities", "cisa_kev", hard)


def malware_reports(reports: DataFrame) -> DataFrame:
    """Reports (family, mitre_techniques, content with indicators_of_compromise as map<string, array<string>>) to examples."""
    content = F.col("content")
    iocs = content["indicators_of_compromise"]
    listed = lambda key: F.array_join(F.coalesce(F.try_element_at(iocs, F.lit(key)), F.array(F.lit("N/A"))), ", ")
    rows = reports.select(
        or_empty(F.col("family")).alias("family"), F.coalesce(content["threat_actor"], F.lit("Unknown Actor")).alias("actor"), or_empty(F.array_join("mitre_techniques", ", ")).alias("techniques"),
        content["initial_access"].alias("access"), content["execution_mechanism"].alias("execution"), content["defense_evasion"].alias("evasion"), content["remediation"].alias("remediation"),
        *[F.coalesce(listed(k), F.lit("N/A")).alias(k) for k in ("sha256", "registry_keys", "network_domains")],
    )
    c = {n: F.col(n) for n in rows.columns}
    input_ = fill("Malware Family: {family}\nThreat Actor: {actor}\nTechnical Summary: Threat advisory report for {family} campaign.", **c)
    return _example(rows, "Perform malware analysis.", input_, fill(MALWARE, **c), "malware", "cisa_threat_advisories", F.lit("expert"))


def title_case(text: Column) -> Column:
    """A capital at the start of every run of cased letters, small letters after it; whatever is no cased letter parts runs."""
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    runs = F.regexp_extract_all(text, F.lit(f"{cased}+|[^{cased[1:-1]}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike(f"^{cased}"), F.initcap(x)).otherwise(x)), "")


def articles(documents: DataFrame, stem: str = "stem", content: str = "content") -> DataFrame:
    """Markdown documents to examples: the first heading or the titled stem, and the first 700 characters cleaned."""
    heading = F.regexp_extract(content, r"#\s*(.+)", 1)
    title = F.when(F.col(content).rlike(r"#\s*.+"), strip(heading)).otherwise(title_case(F.replace(F.col(stem), F.lit("_"), F.lit(" "))))
    input_ = F.concat(F.lit("Threat Category: "), title, F.lit("\nContext: Web Application Vulnerability & Architecture Risk"))
    return _example(documents, "Analyze this security threat and detail prevention controls.", input_, fill(ARTICLE, opening=clean_markdown(F.substring(content, 1, 700))), "security_corpus", "owasp_guidance", F.lit("intermediate"))
