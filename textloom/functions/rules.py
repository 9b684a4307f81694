"""Fixed values of the rule cascades: patterns, bounds, tables. All must stay as they are for equal results."""

MIN_INSTRUCTION, MAX_INSTRUCTION = 20, 2000
MIN_OUTPUT, MAX_OUTPUT = 50, 8000
MAX_INPUT = 4000
MIN_ALPHA, ALPHA_FROM = 0.3, 20

LOW_QUALITY = [
    r"^here is the",
    r"^here are the",
    r"^below is",
    r"^the answer is",
    r"^as an ai",
    r"^i cannot",
    r"^i don't know",
    r"^not sure",
    r"^maybe",
    r"^i think",
    r"^probably",
    r"^\w{1,5}$",
    r"^.{1,10}$",
]

DIFFICULTIES = ["beginner", "intermediate", "advanced", "expert"]

V3_EXPERT = [
    r"\b(use-after-free|uaf|double free|tcache|fastbin|unsorted bin|heap (grooming|feng\s?shui|metadata|overflow))\b",
    r"\b(kernel (privilege escalation|rootkit|module|driver)|commit_creds|prepare_kernel_cred|ring 0|ring-0)\b",
    r"\b(hypervisor (escape|vmm)|sandbox (escape|broker escape)|vm breakout|container breakout)\b",
    r"\b(bleichenbacher|padding oracle attack|coppersmith|håstad|lll algorithm|lattice reduction|elliptic curve discrete log|side-channel timing)\b",
    r"\b(ebpf rootkit|process doppelg\w+|inline hook|driver ioctl exploit|pac bypass|smep|smap|kpti|kaslr bypass)\b",
    r"\b(v8 exploit|turbofan|jit type confusion|browser engine exploit|zero-day root cause|0-day root cause)\b",
    r"\b(glibc|ptmalloc|chunk header|fd pointer|bk pointer|safe linking)\b",
    r"\b(type confusion|arbitrary write primitive|arbitrary read primitive|kernel shellcode)\b",
]
V3_ADVANCED = [
    r"\b(rop chain|return-oriented programming|stack pivot|rop gadget|ret2libc|ret2csu|ret2plt)\b",
    r"\b(aslr|dep/nx|stack canary|pie|relro) (bypass|mitigation|leak|defeat)\b",
    r"\b(format string vulnerability|got overwrite|plt/got lookup|plt/got overwrite)\b",
    r"\b(volatility|unbacked memory|malfind|process hollowing|api unhooking|peb/teb|reflective dll)\b",
    r"\b(insecure deserialization|blind sqli|time-based blind|jwt algorithm confusion|oauth bypass|ssrf to metadata)\b",
    r"\b(reverse engineering|ghidra|ida pro|disassembly analysis|control flow flattening|anti-debug|anti-vm)\b",
    r"\b(kerberoasting|golden ticket|silver ticket|pass-the-hash|dcsync|ntds\.dit|bloodhound|active directory domain)\b",
    r"\b(remote code execution|memory corruption|buffer overflow|stack overflow|integer overflow)\b",
    r"\b(yara rule|cisa advisory|threat actor|apt\d+|ransomware analysis|payload staging)\b",
    r"\b(privilege escalation via suid|gtfobins|capabilities misconfiguration|docker socket exploit)\b",
]
V3_BEGINNER = [
    r"\b(what is|define|concept of|difference between|overview of|introduction to|fundamentals of|basics of)\b",
    r"\b(caesar cipher|rot13|base64|md5|sha256|sha-1|hashing basics|symmetric vs asymmetric|public key vs private key)\b",
    r"\b(port 80|port 443|port 22|port 53|port 21|port 25|port 3389|common ports|well-known ports)\b",
    r"\b(cia triad|confidentiality|integrity|availability|least privilege|defense in depth|social engineering|phishing)\b",
    r"\b(ping|traceroute|nslookup|netstat|ifconfig|ipconfig|whois|dig|curl basics)\b",
    r"\b(steganography basics|exif tool|strings command|ls -la|file header magic numbers)\b",
    r"\b(password policy|mfa|2fa|authentication factors|firewall basics|vpn basics)\b",
    r"\b(osint techniques|google dorking basics|shodan query basics)\b",
]

V2_EXPERT = [
    r"\bheap (feng\s?shui|grooming|consolidation|chunk metadata)\b",
    r"\b(use-after-free|uaf|double free|tcache (poisoning|dup)|fastbin dup)\b",
    r"\b(kernel privilege escalation|kernel rootkit|commit_creds|prepare_kernel_cred)\b",
    r"\b(hypervisor escape|sandbox escape|vm escape|broker escape)\b",
    r"\b(coppersmith|lattice-based|lll algorithm|håstad|fault attack on ecdsa)\b",
    r"\b(ebpf rootkit|process doppelg\w+|inline hook|kernel hook)\b",
    r"\b(pac bypass|smep bypass|smap bypass|kpti|kaslr bypass)\b",
    r"\b(v8 exploitation|turbofan|type confusion in jits?)\b",
    r"\b(zero-day|0-day) root cause\b",
]
V2_ADVANCED = [
    r"\b(rop chain|return-oriented programming|stack pivot|rop gadget)\b",
    r"\b(aslr|dep/nx|canary|pie) (bypass|mitigation|leak)\b",
    r"\b(padding oracle|bleichenbacher|timing attack|rsa factor\w+)\b",
    r"\b(format string vulnerability|got overwrite|ret2libc|ret2csu)\b",
    r"\b(volatility|unlinked dll|process hollowing|api unhooking|peb/teb lookup)\b",
    r"\b(deserialization vulnerability|blind sqli|jwt algorithm confusion)\b",
    r"\b(ghidra decompil\w+|ida pro|disassembly analysis|control flow flattening)\b",
    r"\b(kerberoasting|golden ticket|pass-the-hash|dcsync)\b",
]
V2_BEGINNER = [
    r"\b(what is|define|explain the concept of|difference between)\b",
    r"\b(caesar cipher|rot13|base64 encode|md5 hash|sha256 hash)\b",
    r"\b(standard port|port 80|port 443|port 22|port 53)\b",
    r"\b(intro to|beginner|fundamental|basics of|cia triad)\b",
]
V2_BEGINNER_ANSWER = 600

COUNTED_EXPERT = [
    r"\bheap feng\s?shui\b", r"\bzero-?day\b", r"\b0-?day\b", r"\bkernel rootkit\b", r"\bhypervisor escape\b", r"\bsandbox escape\b",
    r"\buse-?after-?free\b", r"\bv8 exploit\b", r"\bebp[fF] evasion\b", r"\btype confusion\b", r"\brtld_audit\b", r"\blattice reduction\b",
    r"\bcoppersmith\b", r"\bhåstad\b", r"\bblind sqli\b", r"\bbinary exploitation\b", r"\brop chain\b", r"\bkernel\b", r"\baslr bypass\b",
    r"\bformat string\b", r"\bdep bypass\b", r"\bseh overwrite\b",
]
COUNTED_ADVANCED = [
    r"\brop\b", r"\breturn-?oriented\b", r"\bprocess hollowing\b", r"\bbleichenbacher\b", r"\bpadding oracle\b", r"\bshellcode\b",
    r"\bbuffer overflow\b", r"\baslr\b", r"\bvolatility\b", r"\bmalfind\b", r"\bekko\b", r"\bfoliage\b", r"\bcobalt strike\b", r"\bgadget\b",
    r"\bptrace_traceme\b", r"\bgdb-peda\b", r"\bpwntools\b", r"\bimdsv2\b", r"\brsa\b", r"\belliptic curve\b", r"\becc\b",
    r"\bdiffie-?hellman\b", r"\baes-?gcm\b", r"\bdisassembl\w+\b", r"\breverse engineer\w+\b", r"\bghidra\b", r"\bdecompil\w+\b",
    r"\bprivilege escalation\b", r"\bgtfobins\b", r"\bdeserialization\b", r"\bpayload\b",
]
COUNTED_INTERMEDIATE = [
    r"\bctf\b", r"\brxss\b", r"\bxss\b", r"\bsqli\b", r"\bsql injection\b", r"\bssrf\b", r"\bcsrf\b", r"\bsuid\b", r"\bsudoers\b",
    r"\bburp\b", r"\bwireshark\b", r"\bzsteg\b", r"\bbinwalk\b", r"\bpngcheck\b", r"\bnmap\b", r"\bhashcat\b", r"\bjohn the ripper\b",
    r"\bdirsearch\b", r"\bvigenère\b", r"\bcaesar\b", r"\brot13\b", r"\bbase64\b", r"\bsha256\b", r"\bmd5\b", r"\bforensics\b",
    r"\bsteganograph\w+\b", r"\bosint\b", r"\bwhois\b", r"\bdns\b",
]
ADVANCED_LONG, INTERMEDIATE_LONG = 800, 300

#: Category by the first rule of which a word is part of the folded name.
CATEGORIES = [
    ("crypto", ["crypto"]),
    ("web exploitation", ["web", "xss", "sqli", "ssrf"]),
    ("pwn", ["pwn", "buffer", "rop"]),
    ("reverse engineering", ["reverse", "crackme", "ghidra"]),
    ("forensics", ["forensic", "pcap", "steg"]),
    ("osint", ["osint"]),
    ("cve analysis", ["cve", "vuln", "kev"]),
    ("malware analysis", ["malware", "ransomware", "yara"]),
    ("mitre attack", ["mitre", "attack", "threat"]),
    ("secure coding", ["code", "secure", "owasp"]),
    ("linux security", ["linux", "privesc", "gtfo"]),
]
OTHER_CATEGORY = "general security"

FLAG = r"(?i)(FLAG\{[^}]+\}|CTF\{[^}]+\}|picoCTF\{[^}]+\}|HTB\{[^}]+\}|flag\{[^}]+\}|cyber\{[^}]+\})"

MORSE = {
    ".-": "A", "-...": "B", "-.-.": "C", "-..": "D", ".": "E", "..-.": "F", "--.": "G", "....": "H", "..": "I", ".---": "J",
    "-.-": "K", ".-..": "L", "--": "M", "-.": "N", "---": "O", ".--.": "P", "--.-": "Q", ".-.": "R", "...": "S", "-": "T",
    "..-": "U", "...-": "V", ".--": "W", "-..-": "X", "-.--": "Y", "--..": "Z", "-----": "0", ".----": "1", "..---": "2",
    "...--": "3", "....-": "4", ".....": "5", "-....": "6", "--...": "7", "---..": "8", "----.": "9", ".-.-.-": ".",
    "--..--": ",", "..--..": "?", "-.-.--": "!", "-....-": "-", "-..-.": "/", ".--.-.": "@", "---...": ":",
}

MIX_SHARES = [("real_cybersecurity", 0.70), ("ctf_solving", 0.20), ("synthetic_expert", 0.10)]
MIX_TOTAL = 2500
TRAIN_QUOTAS = {"beginner": 225, "intermediate": 1125, "advanced": 675, "expert": 225}
VAL_QUOTAS = {"beginner": 25, "intermediate": 125, "advanced": 75, "expert": 25}
TOKEN_WINDOW = (15, 2048)
NEAR_COPY, LOOK_BACK = 0.92, 50
EVIDENCE_WORDS = ["evidence", "analysis", "solution", "file", "sha", "bytes", "format"]
NOT_RECOVERED = "FLAG NOT RECOVERED"
